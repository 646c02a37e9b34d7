"""Raw loan tables derived from the test tables, as SQL that Spark and the checking database both run.

Orders play loan applications, lineitems the instalments, events the payments and charges, customers the
applicants, suppliers employees and partners, nations branches and codes. Every derived table keeps one or
more rows per source row, so it grows with the test tables.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Tables

AS_OF = date(1998, 6, 30)
RUN_TS = datetime(1998, 6, 30, 18, 30, 15)
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The schedule id is made from the columns that identify a lineitem; event days move to around 1 April 1998.
_PS = "(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 400 + dayofyear(l_shipdate)"
_TS = "ts - INTERVAL 9420 DAY"
# From order 2305843 on, 64 bits do not hold that id and the SQL above has no result. The Spark tables have the same id
# wherever it fits. Other lineitems get a negative one: the order's part is folded into the unused negative numbers, the
# rest is kept, so lineitems of one order stay distinct and in the same sequence.
# A double tells whether the id fits, but for its last 16,000 numbers and keys of mixed sign; large parts of the rest are
# folded as well. With decimals instead, c24 at 60 times sf0.1 did not end in 60 s; so it takes 25 s.
_SIZE = """((((ABS(CAST(l_orderkey AS DOUBLE)) * 10 + ABS(CAST(l_linenumber AS DOUBLE))) * 100000
    + ABS(CAST(l_partkey AS DOUBLE))) * 10000 + ABS(CAST(l_suppkey AS DOUBLE))) * 400)"""
_FOLDED = """((pmod(l_orderkey, 2000000) - 2300000) * 4000000000000 + ((pmod(CAST(l_linenumber AS BIGINT), 1000000) * 100000
    + pmod(l_partkey, 100000000000)) * 10000 + pmod(l_suppkey, 100000000000000)) * 400 + dayofyear(l_shipdate))"""
_PS_WIDE = f"""(CASE WHEN {_SIZE} < 9223372036854760000D THEN {_PS} ELSE {_FOLDED} END)"""

RAW = {
    "tbltypedetail": """
        SELECT CAST(n_nationkey AS BIGINT) AS typedetailid,
               CASE WHEN n_nationkey = 5 THEN 'Fos' ELSE n_name || ' description' END AS typedetaildescription,
               CASE WHEN n_nationkey = 3 THEN 'Cash' ELSE n_name || ' text' END AS typedetaildisplaytext,
               CASE WHEN n_nationkey % 3 = 0 THEN 'Initiated' ELSE 'Other' END AS typedetailcode,
               CASE WHEN n_nationkey % 7 = 6 THEN 0 ELSE 1 END AS isactive FROM {nation}
        UNION ALL
        SELECT CAST(n_nationkey + 180 AS BIGINT), n_name || ' status', n_name || ' loan', 'Status', 1 FROM {nation}""",
    "mstcity": """SELECT CAST(n_nationkey AS BIGINT) AS cityid, n_name || ' city' AS cityname,
        CAST(n_regionkey AS BIGINT) AS districtid, CASE WHEN n_nationkey % 9 = 8 THEN 0 ELSE 1 END AS isactive FROM {nation}""",
    "mstdistrict": """SELECT CAST(n_nationkey AS BIGINT) AS districtid, n_name || ' district' AS districtname, 1 AS isactive FROM {nation}""",
    "mststate": """SELECT CAST(n_nationkey AS BIGINT) AS stateid, n_name || ' state' AS statename,
        CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS isactive FROM {nation}""",
    "mstagency": """SELECT CAST(s_suppkey AS BIGINT) AS agencyid, s_name || ' agency' AS agencyname, 1 AS isactive FROM {supplier}""",
    "mstproduct": """SELECT CAST(n_nationkey AS BIGINT) AS productid, n_name || ' product' AS productname,
        CASE WHEN n_nationkey = 11 THEN 0 ELSE 1 END AS isactive FROM {nation}""",
    "mstloanpurpose": """SELECT CAST(n_nationkey AS BIGINT) AS loanpurposeid, n_name || ' purpose' AS loanpurposename, 1 AS isactive FROM {nation}""",
    "mstregion": """SELECT CAST(r_regionkey AS BIGINT) AS regionid, ' ' || r_name AS regionname,
        CAST(r_regionkey % 2 AS BIGINT) AS zoneid FROM {region}""",
    "mstzone": """SELECT CAST(r_regionkey AS BIGINT) AS zoneid, r_name || ' zone ' AS zonename FROM {region}""",
    "mstportfoliopartner": """SELECT CAST(s_suppkey AS BIGINT) AS partnerid, s_name AS partnername, 1 AS isactive FROM {supplier}""",
    "mstbranch": """
        SELECT CAST(n_nationkey AS BIGINT) AS branchid, CAST(n_nationkey + 500000 AS BIGINT) AS entityid,
               ' ' || n_name || ' branch ' AS branchname, n_name || ' city' AS branchcity, 'state ' || n_name AS statename,
               n_name || ' road' AS branchaddress, CASE WHEN n_nationkey % 4 = 0 THEN ' ' ELSE '12.5' END AS latitude,
               '77.25' AS longitude, 'gst' || n_name AS gstin, CAST(n_regionkey AS BIGINT) AS regionid,
               CAST(n_nationkey AS BIGINT) AS branchinchargeemployeeid, 'nav' || n_name AS navcode, 'cer' AS cersaicode,
               TIMESTAMP '1995-01-01 00:00:00' AS createdon, TIMESTAMP '1996-01-01 00:00:00' AS lastmodifiedon, 1 AS isactive
        FROM {nation}
        UNION ALL
        SELECT CAST(n_nationkey AS BIGINT), CAST(n_nationkey + 500000 AS BIGINT), 'old', 'old', 'old', 'old', '', '', 'old',
               CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'old', 'old', TIMESTAMP '1994-01-01 00:00:00',
               CASE WHEN n_nationkey % 2 = 0 THEN TIMESTAMP '1995-06-01 00:00:00' END, 1 FROM {nation}""",
    "tblloanapplication": """
        SELECT o_orderkey AS loanapplicationid, ' ln' || CAST(o_orderkey AS VARCHAR(20)) AS applicationnumber,
               'sf' || CAST(o_custkey AS VARCHAR(20)) AS salesforceid, o_custkey AS leadid, o_orderkey % 25 AS loanproductid,
               o_orderkey % 23 AS loanpurposeid, o_orderkey % 30 AS refinanceschemeid,
               o_orderkey % 28 AS loanschemetypedetailid, o_custkey % 27 AS interesttypetypedetailid,
               CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS isemployeeloan, o_orderdate AS date,
               o_orderdate + INTERVAL 10 DAY AS firstsanctiondate, o_orderdate + INTERVAL 15 DAY AS lastsanctiondate,
               CAST(o_totalprice AS DECIMAL(18,2)) AS loanamountrequest,
               CAST(o_totalprice * 0.8 AS DECIMAL(18,2)) AS firstsanctionamount,
               CAST(o_totalprice * 0.6 AS DECIMAL(18,2)) AS revisedsanctionamount,
               CAST(240 AS BIGINT) AS tenure, o_custkey % 200 AS sanctionedtenure,
               CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS sanctionedemi,
               CASE o_orderstatus WHEN 'F' THEN 189 WHEN 'O' THEN 190 ELSE 199 END AS statustypedetailid,
               o_custkey % 40 AS channelpartnerdsaid, o_custkey % 50 AS salesofficerempid, o_custkey % 60 AS creditofficerempid,
               CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE 1 END AS isactive,
               o_orderdate + INTERVAL 1 DAY AS createdon, o_orderdate + INTERVAL 40 DAY AS lastmodifiedon
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, 'old', 'old', o_custkey, 1, 1, 1, 1, 1, 0, o_orderdate, o_orderdate, o_orderdate,
               CAST(1 AS DECIMAL(18,2)), CAST(1 AS DECIMAL(18,2)), CAST(1 AS DECIMAL(18,2)), CAST(1 AS BIGINT), 1,
               CAST(1 AS DECIMAL(18,2)), 199, 1, 1, 1, 1, o_orderdate,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 2 DAY END
        FROM {orders} WHERE o_orderkey % 11 = 0 AND o_orderkey % 19 <> 0""",
    "tblloanapplicationadditionaldetail": """
        SELECT o_orderkey AS loanapplicationid, o_orderkey + 5000000 AS loanadditionalid, o_custkey % 25 AS branchid,
               'branch ' || CAST(o_custkey % 25 AS VARCHAR(10)) AS branchname, o_custkey % 5 AS regionid, 'region' AS regionname,
               o_custkey % 2 AS zoneid, 'zone' AS zonename, o_orderdate AS logindate,
               CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS loginamount, o_orderdate + INTERVAL 9 DAY AS firstsancationdate,
               o_orderdate + INTERVAL 20 DAY AS firstdisbursementdate, o_orderdate + INTERVAL 50 DAY AS lastdisbursementdate,
               o_orderdate + INTERVAL 12 DAY AS firstbookeddate, o_orderdate + INTERVAL 30 DAY AS lastbookeddate,
               CAST(o_totalprice * 0.4 AS DECIMAL(18,2)) AS firstbookedamount,
               CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS firstdisbursedamount,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_totalprice * 0.6 AS DECIMAL(18,2)) END AS disbursedamounttilldate,
               CAST(o_totalprice * 0.4 AS DECIMAL(18,2)) AS bookedamounttilldate,
               CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS totalinsuranceamount,
               CAST(o_custkey AS DECIMAL(18,2)) AS currentemi, CAST(9 AS DECIMAL(10,4)) AS currentroi, o_custkey % 100 AS currenttenor,
               o_custkey % 90 AS balancetenor, CAST(o_custkey % 80 AS DECIMAL(10,4)) AS sanctionltv,
               CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 0 END AS isactuallyfullydisbursed,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS isfullybooked, 'officer' AS salesofficername,
               'designation' AS salesofficerdesignation, 'level' AS salesofficerdesignationlevel, 'type' AS inorganictype,
               'tag' AS taggedwith, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS otcpending, 0 AS pddpending,
               o_orderkey % 7 AS titlereasontypedetailid, o_orderdate AS titledeedreceivedate, o_orderkey % 8 AS pddstatustypedetailid,
               o_orderkey % 9 AS otcstatustypedetailid, o_orderkey % 10 AS titledeedstatustypedetailid,
               o_orderkey % 3 AS pendingchequehandovercount, CAST(o_custkey AS DECIMAL(18,2)) AS pendingchequehandoveramount,
               o_orderdate AS loandownsizedate, o_custkey AS createdby, o_custkey AS lastmodifiedby,
               o_orderdate AS frauddetectiondate, 'none' AS fraudtype, o_custkey % 6 AS preferredlanguagetypedetailid,
               o_custkey % 11 AS digitalteamempid, CASE WHEN o_orderkey % 29 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {orders}""",
    "tblloanapplicationdisbursaldetail": """
        SELECT o_orderkey AS loanapplicationid, 'FILE' || CAST(o_orderkey AS VARCHAR(20)) AS fleno,
               o_orderdate + INTERVAL 60 DAY AS emistartdate, o_orderdate + INTERVAL 3600 DAY AS emienddate,
               'Rs ' || CAST(o_custkey AS VARCHAR(20)) || '.25' AS documentvalue, o_orderkey % 28 AS emicycle, 'hypo' AS hypothecation,
               o_orderkey % 12 AS moratoriummonths, ' own ' AS fundingsouce,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 40 END AS partnerengagementid,
               CAST(100 AS DECIMAL(18,2)) AS landplotrate, CAST(200 AS DECIMAL(18,2)) AS existingconstructionbuiltuprate,
               CAST(300 AS DECIMAL(18,2)) AS proposedconstructionbuiltuprate, CAST(400 AS DECIMAL(18,2)) AS constructionsuperbuiltuprate,
               CAST(o_custkey % 90 AS DECIMAL(10,4)) AS ltv, CAST(o_custkey % 91 AS DECIMAL(10,4)) AS ltvwithinsurance,
               CAST(o_custkey % 92 AS DECIMAL(10,4)) AS lcr, CAST(o_custkey % 93 AS DECIMAL(10,4)) AS lcrwithinsurance,
               CAST(o_custkey % 94 AS DECIMAL(10,4)) AS combineddltv, CAST(o_custkey % 95 AS DECIMAL(10,4)) AS combineddlcr,
               o_orderdate AS lastmodifiedon, 1 AS isactive FROM {orders}
        UNION ALL
        SELECT o_orderkey, 'OLD', o_orderdate, o_orderdate, 'none', 1, 'old', 1, 'old', 1, CAST(1 AS DECIMAL(18,2)),
               CAST(1 AS DECIMAL(18,2)), CAST(1 AS DECIMAL(18,2)), CAST(1 AS DECIMAL(18,2)), CAST(1 AS DECIMAL(10,4)),
               CAST(1 AS DECIMAL(10,4)), CAST(1 AS DECIMAL(10,4)), CAST(1 AS DECIMAL(10,4)), CAST(1 AS DECIMAL(10,4)),
               CAST(1 AS DECIMAL(10,4)), o_orderdate - INTERVAL 5 DAY, 1 FROM {orders} WHERE o_orderkey % 7 = 0""",
    "tblapplicationdisbursalreschedulement": f"""
        SELECT l_orderkey AS loanapplicationid, {_PS} AS disbursalreschedulementid,
               CAST(l_quantity AS DECIMAL(10,4)) AS aroi, l_partkey % 28 AS paydueday,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS isactive FROM {{lineitem}}""",
    "tblloanapplicationroispread": """
        SELECT l_orderkey AS loanapplicationid, CAST(l_quantity AS DECIMAL(10,4)) AS baserateinpercentage,
               CAST(l_suppkey % 5 AS DECIMAL(10,4)) AS plrspreadinpercentage, CAST(l_partkey % 20 AS DECIMAL(10,4)) AS finalroi,
               CAST(1 AS DECIMAL(10,4)) AS waiverroiinpercentage, CAST(2 AS DECIMAL(10,4)) AS additionalspread,
               l_shipdate AS lastmodifiedon, CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END AS isactive
        FROM {lineitem}""",
    "tblloanapplicationstatushistory": """
        SELECT l_orderkey AS loanapplicationid, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS isapplicationaccepted,
               l_shipdate AS applicationaccepteddate, CASE WHEN l_partkey % 3 = 0 THEN 1619 ELSE 1600 END AS loanstatustypedetailid,
               l_shipdate AS createdon, l_shipdate AS lastmodifiedon,
               CASE WHEN l_suppkey % 10 = 9 THEN 0 ELSE 1 END AS isactive FROM {lineitem}""",
    "tblloanapplicationpayschedule": f"""
        SELECT {_PS} AS payscheduleid, l_orderkey AS loanapplicationid,
               CASE WHEN l_partkey % 5 = 0 THEN 'PEMI' WHEN l_partkey % 5 = 1 THEN ' emi' ELSE 'EMI' END AS head,
               l_shipdate AS duedate, CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS dueamount,
               CAST(l_extendedprice * 0.8 AS DECIMAL(18,2)) AS principal, CAST(l_extendedprice * 0.2 AS DECIMAL(18,2)) AS interst,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS closingbalance, CAST(l_partkey % 20 AS DECIMAL(10,4)) AS applicableroi,
               CASE WHEN l_returnflag <> 'R' THEN l_shipdate + INTERVAL 3 DAY END AS paymentreceiveddate,
               CAST(l_quantity AS BIGINT) * 25 AS delinquentdays,
               CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_partkey % 2 = 0 THEN 0 END AS clearenceflag,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS isactive FROM {{lineitem}}""",
    "tblloanapplicationruleengineresponse": f"""
        SELECT l_orderkey AS loanapplicationid, {_PS} AS ruleengineresponseid,
               CASE WHEN l_returnflag = 'N' THEN 'sanction' ELSE 'login' END AS outputtype,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS loanofferamount, CAST(l_extendedprice * 0.2 AS DECIMAL(18,2)) AS proposedemi,
               l_suppkey % 300 AS proposedtenor, CAST(l_extendedprice * 0.4 AS DECIMAL(18,2)) AS incomeconsidered,
               CAST(l_extendedprice * 0.6 AS DECIMAL(18,2)) AS obligationconsidered,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS propertyvalue, CAST(l_partkey % 100 AS DECIMAL(10,4)) AS finalfoir,
               CAST(l_partkey % 80 AS DECIMAL(10,4)) AS finalltv, CAST(l_partkey % 85 AS DECIMAL(10,4)) AS combinedltv,
               CAST(l_partkey % 7 AS DECIMAL(10,4)) AS insr, CAST(50 AS DECIMAL(10,4)) AS foirnorm, CAST(60 AS DECIMAL(10,4)) AS ltvnorm
        FROM {{lineitem}}""",
    "tblloanapplicationwaiver": """
        SELECT o_orderkey AS loanapplicationid, CAST(o_custkey % 9 AS DECIMAL(10,4)) AS foirwaiver,
               CASE WHEN o_custkey % 2 = 0 THEN CAST(1 AS DECIMAL(10,4)) END AS ltvwaiver, CAST(2 AS DECIMAL(10,4)) AS waivertenure,
               CAST(3 AS DECIMAL(10,4)) AS lcrwaiver, CAST(NULL AS DECIMAL(10,4)) AS insrwaiver,
               CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanapplicationlinking": """
        SELECT l_orderkey AS loanapplicationid, l_partkey AS linkedloanapplicationid,
               CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS isactive FROM {lineitem}""",
    "tblloanapplicationtvrchecklist": """
        SELECT l_orderkey AS loanapplicationid, CASE WHEN l_suppkey % 9 = 8 THEN NULL ELSE l_suppkey % 5 END AS tvrchecklistid,
               CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS isactive FROM {lineitem}""",
    "tblloanduestatus": """
        SELECT o_orderkey + 7000000 AS loanduestatusid, o_orderkey AS loanapplicationid, o_orderdate + INTERVAL 70 DAY AS transactiondate,
               CASE WHEN o_orderkey % 31 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS pos,
               CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS sellpos,
               CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_custkey AS DECIMAL(18,2)) END AS unadjustedamount,
               o_custkey % 8 * 20 AS maxdeliquencyday, o_orderkey % 5 + 2568 AS deliquencybktdetailid,
               CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS isnpa,
               CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL 80 DAY END AS npastartdate,
               CASE WHEN o_orderkey % 12 = 1 THEN CAST(o_orderkey - 1 AS VARCHAR(20)) WHEN o_orderkey % 12 = 2 THEN ' ' END AS linkednpaloanid,
               o_orderdate AS createdon, o_orderdate + INTERVAL 70 DAY AS lastmodifiedon, 1 AS isactive FROM {orders}
        UNION ALL
        SELECT o_orderkey + 8000000, o_orderkey, o_orderdate, CAST(5 AS DECIMAL(18,2)), CAST(5 AS DECIMAL(18,2)),
               CAST(5 AS DECIMAL(18,2)), o_custkey % 3, 2570, 0, NULL, NULL, o_orderdate, o_orderdate + INTERVAL 10 DAY,
               CASE WHEN o_orderkey % 8 = 0 THEN 0 ELSE 1 END FROM {orders} WHERE o_orderkey % 4 = 0""",
    "tblloanmonthly": f"""
        SELECT MIN({_PS}) AS loanmonthlyid, l_orderkey AS loanapplicationid, CAST(year(l_shipdate) AS INT) AS summaryyear,
               CAST(month(l_shipdate) AS INT) AS summarymonth,
               CASE WHEN MAX(l_partkey) % 10 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(MAX(l_extendedprice) AS DECIMAL(18,2)) END AS pos,
               CAST(MAX(l_extendedprice) * 0.2 AS DECIMAL(18,2)) AS sellpos,
               CASE WHEN MAX(l_partkey) % 6 <> 0 THEN CAST(MAX(l_extendedprice) * 0.4 AS DECIMAL(18,2)) END AS dueinterest,
               CAST(MAX(l_extendedprice) * 0.6 AS DECIMAL(18,2)) AS dueprinciple,
               CAST(MAX(l_extendedprice) AS DECIMAL(18,2)) AS previousdue, CAST(1 AS DECIMAL(18,2)) AS outstandinginsurance,
               CAST(2 AS DECIMAL(18,2)) AS accuredinterestnotdue, MAX(l_partkey) % 5 * 30 AS maxdeliquencyday,
               MAX(l_partkey) % 6 + 2568 AS deliquencybktdetailid,
               CASE WHEN MAX(l_partkey) % 5 = 4 THEN 1 ELSE 0 END AS isnpa,
               CASE WHEN MAX(l_partkey) % 5 = 4 THEN MIN(l_shipdate) END AS npastartdate, 'STD' AS assetclassification,
               MIN(l_shipdate) AS assetclassificationdate,
               CASE WHEN MAX(l_partkey) % 4 = 0 THEN '1' WHEN MAX(l_partkey) % 4 = 1 THEN '0' WHEN MAX(l_partkey) % 4 = 2 THEN 'NULL' END AS isrestructured,
               MAX(l_partkey) % 25 + 180 AS statustypedetailid, CAST(3 AS DECIMAL(18,2)) AS provisionsvalue,
               CAST(4 AS DECIMAL(10,4)) AS riskweight, 'fund' AS sourcefundingname, 'liab' AS liabilitycode,
               MAX(l_suppkey) % 50 AS engagementid, CAST(9 AS DECIMAL(10,4)) AS roi, CAST(70 AS DECIMAL(10,4)) AS currentltv,
               MIN(l_shipdate) AS fixedstartdate, MAX(l_suppkey) % 12 AS fixedduration, 'coll' AS collectionstatus,
               'pres' AS presentationstatus, 'bkt' AS collectionbkt, MAX(l_suppkey) % 240 AS balancetenor,
               MIN(l_shipdate) AS createdon, MAX(l_shipdate) AS lastmodifiedon,
               CASE WHEN MAX(l_linenumber) = 7 AND MAX(l_partkey) % 3 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {{lineitem}} GROUP BY l_orderkey, year(l_shipdate), month(l_shipdate)""",
    "tblportfoliopartnerengagementdetail": """
        SELECT s_suppkey AS engagementid, s_suppkey + 3 AS partnerid, CASE WHEN s_suppkey % 2 = 0 THEN 'SELL' ELSE 'COLEND' END AS engagementtype,
               CASE WHEN s_suppkey % 5 <> 0 THEN 'DA' END AS assignmenttype,
               CAST(s_suppkey % 4 * 20 AS DECIMAL(10,4)) AS percentage, TIMESTAMP '1997-04-01 00:00:00' AS startdate,
               CASE WHEN s_suppkey % 13 = 12 THEN 0 ELSE 1 END AS isactive FROM {supplier}""",
    "tblportfoliopartnerengagementloandetails": """
        SELECT o_orderkey AS loanapplicationid, CAST(o_custkey % 100 AS DECIMAL(10,4)) AS percentage,
               CASE WHEN o_orderkey % 10 = 5 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanapplicationmanualreceipt": f"""
        SELECT event_id AS receiptid, event_id % 500 AS draftreceiptid, user_id AS loanapplicationid,
               CASE WHEN event_id % 7 = 0 THEN 220 ELSE 219 END AS statustypedetailid, {_TS} AS statusupdateddate,
               {_TS} - INTERVAL 2 DAY AS dateofcollection,
               CASE WHEN event_id % 11 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS collectedamount,
               event_id % 6 AS collectedthroughtypedetailid, CASE WHEN event_id % 3 = 0 THEN 1860 ELSE 1861 END AS feesfortypedetailid,
               1 AS isknockoff, 'chq' || CAST(event_id AS VARCHAR(20)) AS chequenumber, CAST(0 AS DECIMAL(18,2)) AS unadjustmentamount,
               {_TS} AS createdon, CASE WHEN event_id % 13 = 0 OR user_id % 5 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {{events}} WHERE event_type = 'purchase'""",
    "tblloanapplicationpresentationdetail": f"""
        SELECT event_id AS presentationdetailid, event_id AS presentationid, user_id AS loanapplicationid,
               CASE WHEN event_id % 7 = 0 THEN 2067 ELSE 2066 END AS statustypedetailid, {_TS} AS statusdate,
               {_TS} - INTERVAL 1 DAY AS pdcachdate, CAST(value AS DECIMAL(18,2)) AS pdcachamount, 0 AS isknockoff,
               'ref' || CAST(event_id AS VARCHAR(20)) AS chequerefrenceno, event_id % 20 AS bouncereasontypedetailid, 1 AS ispresented,
               {_TS} AS lastmodifiedon, CASE WHEN event_id % 13 = 0 OR user_id % 4 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {{events}} WHERE event_type = 'click'""",
    "tblloanapplicationpresentationbatch": """
        SELECT event_id AS presentationid, event_id % 6 AS presentationtypedetailid,
               CASE WHEN event_id % 4 = 0 THEN 1 WHEN event_id % 4 = 1 THEN 0 END AS isrepresentation,
               CASE WHEN event_id % 10 = 9 THEN 0 ELSE 1 END AS isactive FROM {events} WHERE event_type = 'click'""",
    "tblloanpaymentadjust": f"""
        SELECT l_orderkey AS loanapplicationid, CASE WHEN l_partkey % 30 <> 0 THEN {_PS} END AS payscheduleid,
               CASE WHEN l_partkey % 2 = 0 THEN 'presentation' ELSE 'manualreceipt' END AS paytype,
               CASE WHEN l_partkey % 2 = 0 THEN l_partkey END AS presentationdetailid,
               CASE WHEN l_partkey % 2 = 1 THEN l_partkey END AS receiptid,
               CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS isactive FROM {{lineitem}} WHERE l_returnflag <> 'R'""",
    "tblloanapplicationchargedetails": f"""
        SELECT event_id AS loanapplicationchargedetailid, user_id AS loanapplicationid, event_id % 3 + 1 AS typedetailchargeid,
               CASE WHEN event_id % 10 < 9 THEN 1561 ELSE 1562 END AS chargesfortypedetailid,
               CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '1998-06-30 00:00:00' ELSE {_TS} END AS chargedate,
               CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '1998-06-30 10:00:00' END AS knockoffdate,
               CAST(value AS DECIMAL(18,2)) AS totalcharge, CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {{events}} WHERE event_type IN ('error', 'signup')""",
    "tblcollectionfollowup": f"""
        SELECT user_id AS loanapplicationid, event_id % 25 AS followuptypedetailid, {_TS} AS followupdate,
               CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS islastrecord, 1 AS isactive FROM {{events}} WHERE event_type = 'view'""",
    "tblloanapplicationunderwriting": """
        SELECT l_orderkey AS loanapplicationid, l_suppkey + 900000 AS createdby,
               CASE WHEN l_linenumber % 2 = 1 THEN 237 ELSE 238 END AS underwritingstatustypedetailid,
               l_shipdate + l_partkey * INTERVAL 1 SECOND AS lastmodifiedon FROM {lineitem}""",
    "tbluser": """
        SELECT s_suppkey + 900000 AS userid, CASE WHEN s_suppkey < 25 THEN s_suppkey + 500000 ELSE s_suppkey + 600000 END AS entityid,
               s_suppkey + 800000 AS parententityid, s_suppkey % 9 AS usertypedetailid,
               CASE WHEN s_suppkey % 11 = 10 THEN 0 ELSE 1 END AS isactive FROM {supplier}""",
    "tbluserbranch": """
        SELECT s_suppkey + 100 AS userbranchid, s_suppkey + 900000 AS userid, CAST(s_nationkey AS BIGINT) AS branchid, 1 AS isactive FROM {supplier}
        UNION ALL
        SELECT s_suppkey + 200000, s_suppkey + 900000, CAST((s_nationkey + 1) % 25 AS BIGINT), 1 FROM {supplier} WHERE s_suppkey % 3 = 0""",
    "tblemployee": """
        SELECT s_suppkey AS employeeid, ' emp' || CAST(s_suppkey AS VARCHAR(10)) AS employeecode, s_name || ' ' AS employeename,
               'new' || CAST(s_suppkey AS VARCHAR(10)) AS newemployeeid,
               CASE WHEN s_suppkey < 25 THEN s_suppkey + 500000 ELSE s_suppkey + 600000 END AS entityid,
               CAST(s_nationkey AS BIGINT) AS basebranchid, s_suppkey % 7 AS departmentid, s_suppkey % 8 AS designationtypedetailid,
               s_suppkey % 4 AS designationleveltypedetailid, s_suppkey % 10 AS parentemployeeid,
               TIMESTAMP '1995-05-05 00:00:00' AS joiningdate, CAST(NULL AS TIMESTAMP) AS relivingdate,
               CASE WHEN s_suppkey % 6 = 0 THEN 'TRUE' WHEN s_suppkey % 6 = 1 THEN 'n' WHEN s_suppkey % 6 = 2 THEN '0' END AS isresigned,
               TIMESTAMP '1995-05-05 00:00:00' AS createdon, TIMESTAMP '1997-05-05 00:00:00' AS lastmodifiedon,
               CASE WHEN s_suppkey % 17 = 16 THEN 0 ELSE 1 END AS isactive FROM {supplier}""",
    "tblapplicantriskdetail": """
        SELECT o_orderkey AS loanapplicationid, CAST(o_totalprice * 0.4 AS DECIMAL(18,2)) AS securedamount,
               CAST(o_totalprice AS DECIMAL(18,2)) AS totalamount, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS isactive
        FROM {orders}""",
    "tblapplicationpropertydetail": """
        SELECT o_orderkey + 3000000 AS applicantpropertydetailid, o_orderkey AS loanapplicationid, o_orderkey % 26 AS unittypetypedetailid,
               o_custkey % 26 AS propertytypedetailid, o_custkey % 24 AS ownershiptypedetailid,
               o_custkey % 23 AS natureofpropertytransactiontypedetailid, o_custkey % 22 AS endusetypedetailid,
               o_custkey % 21 AS propertydocumenttypedetailid, o_custkey % 20 AS alreadyownedpropertytypedetailid,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS isfirstproperty,
               CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 5 = 1 THEN 0 END AS isnegativearea,
               CASE WHEN o_orderkey % 6 <> 0 THEN 'plot ' || CAST(o_orderkey AS VARCHAR(20)) END AS propertyaddress,
               CASE WHEN o_orderkey % 4 <> 0 THEN 'near ' || o_orderpriority END AS landmark,
               CASE WHEN o_orderkey % 7 = 0 THEN '11A' ELSE ' ' || CAST(110000 + o_custkey AS VARCHAR(10)) END AS pincode,
               CASE WHEN o_orderkey % 8 = 0 THEN '12.5' ELSE CAST(o_custkey AS VARCHAR(10)) || ' ' END AS propertyareasquareft,
               CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE 'Rs. ' || CAST(o_custkey AS VARCHAR(10)) END AS mvofproperty,
               o_custkey % 26 AS cityid, o_custkey % 25 AS districtid, o_custkey % 25 AS stateid, o_orderdate AS createdon,
               o_orderdate + INTERVAL 3 DAY AS lastmodifiedon, CASE WHEN o_orderkey % 16 = 15 THEN 0 ELSE 1 END AS isactive
        FROM {orders}
        UNION ALL
        SELECT o_orderkey + 4000000, o_orderkey, 1, 1, 1, 1, 1, 1, 1, 0, 1, 'second', '', '1', '1', '7.125', 1, 1, 1, o_orderdate,
               o_orderdate, 1 FROM {orders} WHERE o_orderkey % 10 = 3""",
    "tblloantechnicalpropertysurrounding": """
        SELECT o_orderkey AS loanapplicationid, o_orderkey + 1 AS parentpropertyid,
               CASE WHEN o_orderkey % 4 = 0 THEN '0' WHEN o_orderkey % 4 <> 1 THEN 'visited ' || o_orderpriority END AS technicaladdress,
               o_custkey % 24 AS pacitytehsiltalukatownid, o_custkey % 23 AS padistrictid, o_custkey % 22 AS pastateid,
               CAST(120000 + o_custkey AS VARCHAR(10)) AS papincode,
               CASE WHEN o_orderkey % 3 = 0 THEN '12.9716 s' WHEN o_orderkey % 3 = 1 THEN 'lat 28.5 N' ELSE 'n.a.' END AS latitude,
               CASE WHEN o_orderkey % 3 = 0 THEN '77.5W' ELSE '-77.25' END AS longitude, 'colony' AS pacolonyprojectname,
               'khasra' AS pakhasrasurveyno, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 END AS isitselfoccupiedpropertybyapplicanttypedetailid,
               o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 9 = 8 THEN 0 ELSE 1 END AS isactive FROM {orders}""",
    "tblloantechnicaldiligencevaluation": """
        SELECT o_orderkey AS loanapplicationid, 'INR ' || CAST(o_custkey AS VARCHAR(10)) || '.50' AS valuationtotalfairmarketvalue,
               CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR(10)) || '.125' END AS valuationlandarea,
               ' 45.5 ' AS valuationlandarearatepersquarefeet, '100' AS valuationbuiltupareaexisting, '200.75' AS valuationbuiltupareaproposed,
               CAST(o_custkey AS VARCHAR(10)) AS valuationsuperbuiltuparea, '55%' AS valuationbuilding, ' 60 %' AS valuationunitbeingfunded,
               '46' AS valuationbuiltupareaproposedratepersquarefeet, '47' AS valuationsuperbuiltuparearatepersquarefeet,
               '800' AS valuationcarpetarea, '48' AS valuationcarpetarearatepersquarefeet,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 WHEN o_orderkey % 3 = 0 THEN 0 END AS iscompliantwithndmaguidelines,
               CAST(o_totalprice AS DECIMAL(18,2)) AS valuationdistresssalevalue, o_orderdate AS lastmodifiedon,
               CASE WHEN o_orderkey % 6 <> 0 THEN 1 ELSE 0 END AS isactive
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, 'old', 'old', 'old', 'old', 'old', 'old', 'old', 'old', 'old', 'old', 'old', 'old', 0, CAST(0 AS DECIMAL(18,2)),
               o_orderdate - INTERVAL 9 DAY, 1 FROM {orders} WHERE o_orderkey % 6 = 5""",
    "tblloantechnicalreport": """SELECT o_orderkey AS loanapplicationid, o_orderdate + INTERVAL 4 DAY AS propertyvisitdate,
        o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloantechnicalreportvetting": """SELECT o_orderkey AS loanapplicationid, o_custkey % 25 AS classificationtypedetailid,
        o_custkey % 24 AS urbanruraltypedetailid, o_custkey % 23 AS transitiontypedetailid, o_orderkey * 2 AS loantechnicalfiringid,
        o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 10 = 1 OR o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS isactive FROM {orders}""",
    "tblloantechnicalfiring": """
        SELECT o_orderkey AS loanapplicationid, o_orderkey * 2 AS loantechnicalfiringid, o_custkey % 90 AS agencyid,
               o_custkey % 25 AS reportfiringtypedetailid, o_orderdate + INTERVAL 2 DAY AS firingdate,
               o_orderdate + INTERVAL 6 DAY AS reportreceiveddate, o_orderdate AS lastmodifiedon, 1 AS isactive FROM {orders}
        UNION ALL
        SELECT o_orderkey, o_orderkey * 2 + 1, 1, 1, o_orderdate, o_orderdate, o_orderdate + INTERVAL 90 DAY, 1 FROM {orders}""",
    "tblloanlegalreport": """
        SELECT o_orderkey AS loanapplicationid, CASE WHEN o_orderkey % 3 <> 0 THEN 'H' || CAST(o_custkey AS VARCHAR(10)) ELSE ' ' END AS houseno,
               CASE WHEN o_orderkey % 2 = 0 THEN 'F2' END AS floorno, '' AS wingno, ' B1 ' AS buildingno, 'P' AS plotno, 'S' AS surveyno,
               CASE WHEN o_orderkey % 5 = 0 THEN 'St' END AS streetno, NULL AS stageno, 'mark' AS landmark, 'village' AS village,
               ' ' AS mouza, o_custkey % 25 AS cityid, o_custkey % 24 AS districtid, o_custkey % 23 AS stateid, '560001' AS pincode,
               'adv' AS advocatename, o_custkey % 25 AS legaldetailstatustypedetailid,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 3 END AS vendorclearandmarketabletitletypedetailid,
               o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 8 <> 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanlegalfiring": """SELECT o_orderkey AS loanapplicationid, o_custkey % 95 AS agencyid, o_custkey % 25 AS legalfiringstatustypedetailid,
        o_orderdate + INTERVAL 1 DAY AS firingdate, o_orderdate + INTERVAL 5 DAY AS reportreceiveddate, 0 AS isrefire,
        CAST(NULL AS TIMESTAMP) AS isrefiringdate, o_orderdate AS lastmodifiedon,
        CASE WHEN o_orderkey % 5 <> 4 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanrevpropvaluation": """SELECT o_orderkey AS loanapplicationid, CAST(o_totalprice AS DECIMAL(18,2)) AS revisedmarketvalue,
        CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + INTERVAL 8 DAY END AS valuationdate, o_orderdate AS createdon,
        o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 2 = 1 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblapplicant": """
        SELECT o_orderkey * 2 AS applicantid, o_custkey AS entityid, o_orderkey AS loanapplicationid, o_orderkey * 2 AS parentapplicantid,
               CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE ' ' || c_mktsegment END AS firstname,
               CASE WHEN o_orderkey % 3 = 0 THEN 'M' WHEN o_orderkey % 3 = 1 THEN '' END AS middlename,
               CASE WHEN o_orderkey % 10 <> 0 THEN c_name || ' ' END AS lastname, 'Fa' AS fatherfirstname, ' ' AS fathermiddlename, 'Ther' AS fatherlastname,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Mo' END AS motherfirstname, 'Th' AS mothermiddlename, 'Er' AS motherlastname,
               '' AS spousefirstname, ' ' AS spousemiddlename, CASE WHEN o_orderkey % 2 = 1 THEN 'Spouse' END AS spouselastname,
               o_orderdate - INTERVAL 9000 DAY AS dateofbirth, o_custkey % 60 + 20 AS age, o_custkey % 25 AS gendertypedetailid,
               o_custkey % 24 AS maritialstatustypedetailid, o_custkey % 23 AS nationalitytypedetailid, o_custkey % 22 AS religiontypedetailid,
               o_custkey % 21 AS castetypedetailid, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 0 END AS isminority,
               1 AS ismainapplicant, o_custkey % 20 AS relationshiptypedetailid, 0 AS isdisabled, 1 AS isexservicemen, 2 AS ismanualscavenger,
               CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 5 END AS ishomemakertypedetailid, o_custkey % 19 AS qualificationtypedetailid,
               o_custkey % 18 AS detailqualificationtypedetailid, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 5 END AS livingstandardtypedetailid,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS isnegativeprofile, 0 AS iscustomerhavepoliticallink,
               CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 0 END AS isregularrtrpostdefault, o_custkey % 4 AS noofpropertyowned,
               1 AS incomeconsidered, c_name AS nameasperaadhar, o_custkey % 17 AS risktypedetailid,
               o_orderdate AS createdon, o_orderdate + INTERVAL 5 DAY AS lastmodifiedon
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_custkey + 1, o_orderkey, o_orderkey * 2, 'Co', '', o_orderpriority, '', '', '', 'A', 'B', 'C', '', '', '',
               o_orderdate - INTERVAL 8000 DAY, 30, 1, 1, 1, 1, 1, 0, 0, o_custkey % 25, 1, 0, 0, NULL, 2, 2, NULL, 0, 0, NULL, 0, 0, 'Co',
               CASE WHEN o_orderkey % 2 = 0 THEN 3 END, o_orderdate, o_orderdate + INTERVAL 6 DAY FROM {orders} WHERE o_orderkey % 3 = 0
        UNION ALL
        SELECT o_orderkey * 2, 1, o_orderkey, 1, 'stale', '', '', '', '', '', '', '', '', '', '', '', o_orderdate, 1, 1, 1, 1, 1, 1, 0, 0, 1, 0, 0, 0,
               NULL, 1, 1, NULL, 0, 0, 0, 0, 0, 'stale', 1, o_orderdate, CASE WHEN o_orderkey % 8 = 0 THEN o_orderdate END
        FROM {orders} WHERE o_orderkey % 4 = 0""",
    "tblapplicantrisk": f"""SELECT user_id * 2 AS applicantid, event_id % 25 AS risktypedetailid, {_TS} AS reevaluatedon,
        CASE WHEN event_id % 4 = 0 OR user_id % 3 = 0 THEN 0 ELSE 1 END AS isactive FROM {{events}} WHERE event_type = 'signup'""",
    "tbladdress": """
        SELECT c_custkey AS entityid, c_name || ' street' AS address1, c_custkey % 25 AS cityid, c_custkey % 24 AS districtid,
               'town' AS cityname, '110001' AS zip, c_mktsegment AS landmark, 'block' AS blocktaluka, c_custkey % 30 AS stayinginyears,
               c_custkey % 25 AS addresstypedetailid, c_custkey % 22 AS residencetypetypedetailid,
               TIMESTAMP '1997-01-01 00:00:00' AS lastmodifiedon, CASE WHEN c_custkey % 12 = 11 THEN 0 ELSE 1 END AS isactive FROM {customer}
        UNION ALL
        SELECT c_custkey, 'old', 1, 1, 'old', 'old', 'old', 'old', 1, 1, 1, TIMESTAMP '1996-01-01 00:00:00', 1 FROM {customer} WHERE c_custkey % 2 = 0""",
    "tblapplicantoccupationaldetail": """
        SELECT o_orderkey * 2 AS applicantid, o_orderkey AS loanapplicationid, o_custkey % 25 AS profilesegmenttypedetailid,
               o_custkey % 24 AS subprofiletypedetailid, ' acme ' || o_orderpriority AS companyname, o_custkey % 20 + 50 AS retirementage,
               o_custkey % 23 AS industrytypedetailid, o_custkey % 22 AS subindustrytypedetailid, o_custkey % 21 AS constitutiontypedetailid,
               o_custkey % 20 AS nhbqoccupationtypedetailid, o_custkey % 19 AS occupationsubtypedetailid, o_custkey % 18 AS employmenttypedetailid,
               o_custkey % 17 AS sectortypedetailid, 'clerk' AS designation, 'gst' AS gstregistration,
               o_orderdate - INTERVAL 3000 DAY AS dateofincorporation, o_orderdate - INTERVAL 2000 DAY AS dateofjoining,
               o_custkey % 15 AS totalexperience, o_custkey % 14 AS businessvinatgeinyear, o_custkey % 6 AS businesssetuptypedetailid,
               0 AS ispensioner, 1 AS issalaryslipavailable, 0 AS ismultipleearner, o_orderdate AS lastmodifiedon,
               CASE WHEN o_orderkey % 7 <> 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblapplicantincome": """SELECT o_orderkey * 2 AS applicantid, o_orderkey AS loanapplicationid,
        CAST(o_totalprice * 0.2 AS DECIMAL(18,2)) AS applicantgrossincome, CAST(o_totalprice * 0.4 AS DECIMAL(18,2)) AS assessedmonthlyincome,
        o_orderdate AS lastmodifiedon, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1 END AS isactive FROM {orders}""",
    "tblapplicantkyc": """
        SELECT l_orderkey * 2 AS applicantid, l_orderkey AS loanapplicationid,
               CASE l_linenumber WHEN 1 THEN 56 WHEN 2 THEN 230 WHEN 3 THEN 233 WHEN 4 THEN 231 WHEN 5 THEN 232 ELSE 99 END AS identificationtypedetailid,
               'ID' || CAST(l_partkey AS VARCHAR(10)) AS identificationnumber, 'UID' || CAST(l_suppkey AS VARCHAR(10)) AS refuid,
               l_partkey % 10000 AS uidlastdigit, l_suppkey % 27 AS verifiedstatustypedetailid,
               CASE WHEN l_linenumber > 4 THEN 1 ELSE 0 END AS isuseforperformkyc,
               l_shipdate + l_partkey * INTERVAL 1 SECOND AS lastmodifiedon,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS isactive FROM {lineitem}""",
    "tblentitybureau": """SELECT o_custkey AS entityid, o_orderkey AS loanapplicationid, o_custkey % 600 + 300 AS score,
        CASE WHEN o_orderkey % 3 = 0 THEN 411 ELSE 410 END AS bureautypedetailid, o_orderdate AS reportdate, 1 AS isactive FROM {orders}""",
    "tblascoremodel": """SELECT o_orderkey * 2 AS applicantid, o_orderkey AS loanapplicationid, o_custkey % 1000 AS underwritingscore,
        'B' || CAST(o_custkey % 5 AS VARCHAR(5)) AS creditbucket, o_orderdate AS createdon,
        CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblapplicantexistingobligation": f"""SELECT l_orderkey * 2 AS applicantid, l_orderkey AS loanapplicationid, {_PS} AS existingobligationid,
        CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_extendedprice * 0.2 AS DECIMAL(18,2)) END AS emiamount,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS loanamount, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS isactive FROM {{lineitem}}""",
    "tblcustomersegmentationmodel": """SELECT o_orderkey * 2 AS applicantid, o_orderkey AS loanapplicationid, o_orderpriority AS custsegment,
        CASE WHEN o_orderkey % 3 <> 1 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanapplicationadditionalbureau": """SELECT o_orderkey AS loanapplicationid, o_custkey % 25 AS currentstateid, 'office ' || o_orderpriority AS officeaddress,
        o_custkey % 500 AS experianscore, CASE WHEN o_orderkey % 4 <> 2 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblloanbtsummary": """SELECT o_orderkey AS loanapplicationid, CAST(o_totalprice * 0.4 AS DECIMAL(18,2)) AS btloanamount,
        CASE WHEN o_orderkey % 6 = 3 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tblemploymentudhyamdetails": """SELECT o_orderkey * 2 AS applicantid, 'UDYAM' || CAST(o_custkey AS VARCHAR(10)) AS udhyamregnumber,
        o_orderdate AS udhyamissuedate, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
    "tbldsa": """SELECT s_suppkey AS dsaid, s_suppkey + 700000 AS entityid, s_suppkey % 26 AS channeltypetypedetailid,
        CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS isdormant, CAST(s_nationkey AS BIGINT) AS baselocation,
        CASE WHEN s_suppkey % 12 = 11 THEN 0 ELSE 1 END AS isactive FROM {supplier}""",
    "tbldsarenewal": """
        SELECT s_suppkey AS dsaid, 'DSA' || CAST(s_suppkey AS VARCHAR(10)) AS dsacode, s_name AS companyname,
               TIMESTAMP '1997-01-01 00:00:00' AS contractstartdate, TIMESTAMP '1999-01-01 00:00:00' AS contractenddate,
               s_suppkey % 25 AS typeoforganisationtypedetailid, 1 AS iskycdetailverified, 0 AS isreportverified, 1 AS isfiverified,
               0 AS iscibilverified, 1 AS isfcuverified, 0 AS isagreementverified, 1 AS ispayoutannexureverified, 0 AS iscorporate,
               CAST(2 AS DECIMAL(10,4)) AS standardpayout, s_suppkey % 24 AS approvalstatustypedetailid,
               TIMESTAMP '1996-12-01 00:00:00' AS createdon, TIMESTAMP '1997-02-01 00:00:00' AS lastmodifiedon,
               CASE WHEN s_suppkey % 9 <> 8 THEN 1 ELSE 0 END AS isactive
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey, 'OLD', 'old', TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '1996-01-01 00:00:00', 1, 0, 0, 0, 0, 0, 0, 0, 1,
               CAST(1 AS DECIMAL(10,4)), 1, TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '1995-02-01 00:00:00', 1 FROM {supplier} WHERE s_suppkey % 2 = 0""",
    "tbldsarequest": """SELECT CASE WHEN s_suppkey % 3 <> 0 THEN 'DSA' ELSE 'DRAFT' END || CAST(s_suppkey AS VARCHAR(10)) AS draftdsaid, s_suppkey % 23 AS typeoforganisationtypedetailid,
        s_suppkey % 22 AS occupationtypedetailid FROM {supplier}""",
    "tblentitycoveredbranch": """SELECT s_suppkey + 700000 AS entityid, l_partkey % 25 AS entitycoveredbranchid,
        CASE WHEN l_linenumber = 7 OR s_suppkey % 5 = 0 THEN 0 ELSE 1 END AS isactive FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey""",
    "tblloanapplicationach": """SELECT l_orderkey AS loanapplicationid, CASE WHEN l_partkey % 3 = 0 THEN 1 WHEN l_partkey % 3 = 1 THEN 0 END AS registered,
        CASE WHEN l_suppkey % 3 = 0 THEN 1991 WHEN l_suppkey % 3 = 1 THEN 1990 END AS registeredstatustypedetailid,
        CASE WHEN l_linenumber IN (2, 3) THEN 1 ELSE 0 END AS isactive FROM {lineitem}""",
    "tblloanlegaldocuments": """SELECT l_orderkey AS loanapplicationid,
        CASE l_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 16 WHEN 2 THEN 209 ELSE 99 END AS documentid,
        CASE WHEN l_linenumber < 5 THEN 3256 ELSE 3255 END AS documentcategorydetailid, 1957 AS documenttypedetailid,
        CASE WHEN l_suppkey % 3 = 0 THEN 1948 WHEN l_suppkey % 3 = 1 THEN 1950 END AS documentstatustypedetailid FROM {lineitem}""",
    "tbllead": """SELECT o_orderkey AS leadid, ' L' || CAST(o_orderkey AS VARCHAR(20)) AS leadnumber, 'sf' AS salesforceid, ' web ' AS leadsource,
        'sub ' AS leadsubsource, 'mobile' AS devicetype, o_custkey % 25 AS sourcingchannelpartnertypedetailid,
        o_custkey % 30 AS campaniantypedetailid, o_custkey % 24 AS currentstatustypedetailid, o_custkey % 40 AS dsaid,
        ' First' AS applicantfirstname, CASE WHEN o_orderkey % 3 = 0 THEN 'Mid' WHEN o_orderkey % 3 = 1 THEN ' ' END AS applicantmiddlename,
        'Last' AS applicantlastname, CAST(o_totalprice AS DECIMAL(18,2)) AS amountrequest, o_orderkey % 25 AS loanproductid,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS isconvertedtoloanapplication, o_custkey % 25 AS branchid,
        o_orderdate AS createdon, o_orderdate AS lastmodifiedon FROM {orders}""",
    "tblleadfollowup": f"""SELECT CASE WHEN l_returnflag <> 'A' THEN l_orderkey ELSE -l_orderkey END AS leadid, {_PS} AS leadfollowupid,
        l_shipdate AS createdon FROM {{lineitem}}""",
    "tblloanapplicationdisbursmentfavouring": f"""SELECT l_orderkey AS loanapplicationid, {_PS} AS favouringid, l_shipdate AS disburseddate,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS disbursedamount, l_partkey % 25 AS favouringcategorytypedetailid,
        l_suppkey % 25 AS transactiontypedetailid, l_shipdate AS createdon, l_shipdate + INTERVAL 1 DAY AS lastmodifiedon,
        CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS isactive FROM {{lineitem}}""",
    "tblloanapplicationpdreport": """SELECT o_orderkey AS loanapplicationid, o_custkey + 600000 AS pddonebyentityid, o_custkey % 25 AS pdstatustypedetailid,
        o_orderdate + INTERVAL 7 DAY AS dateperformed, o_orderdate AS lastmodifiedon,
        CASE WHEN o_orderkey % 4 <> 3 THEN 1 ELSE 0 END AS isactive FROM {orders}""",
}

# Silver tables as the operators read them, derived the same way.
RAW |= {
    "slv_loan_details": """
        SELECT CASE WHEN o_orderkey % 40 <> 39 THEN o_orderkey ELSE -o_orderkey END AS loan_application_id, CASE WHEN o_orderkey % 50 <> 49 THEN o_custkey % 26 END AS branch_id,
               o_custkey % 50 AS sales_officer_emp_id, CAST(o_orderdate AS DATE) AS login_date,
               o_orderdate + INTERVAL 15 DAY AS last_sanction_date, o_orderdate + INTERVAL 30 DAY AS last_booked_date,
               CASE WHEN o_orderkey % 33 = 1 THEN TIMESTAMP '1996-12-31 00:00:00' WHEN o_orderkey % 33 = 2 THEN TIMESTAMP '1998-03-31 00:00:00'
                    ELSE o_orderdate + INTERVAL 20 DAY END AS first_disbursal_date, o_orderdate + INTERVAL 50 DAY AS last_disbursal_date,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_totalprice * 0.6 AS DECIMAL(18,2)) END AS total_disbursed_amount,
               o_orderkey % 23 AS loan_purpose_id, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 0 END AS is_actually_fully_disbursed,
               CASE o_orderstatus WHEN 'F' THEN 189 WHEN 'O' THEN 190 ELSE 199 END AS loanstatus_typedetail_id,
               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 100 AS DECIMAL(10,4)) END AS final_foir_pct,
               o_orderkey % 17 = 0 AS is_employee_loan FROM {orders}""",
    "slv_contract_perf_monthly": """
        SELECT loanmonthlyid AS loan_monthly_id, loanapplicationid AS loan_application_id, make_date(summaryyear, summarymonth, 1) AS snapshot_date,
               pos, maxdeliquencyday AS max_dpd, isnpa AS is_npa, dueinterest AS due_interest, dueprinciple AS due_principal
        FROM {tblloanmonthly} WHERE isactive = 1""",
    "slv_customer": """
        SELECT CASE WHEN o_orderkey % 7 <> 6 THEN o_orderkey ELSE -o_orderkey END AS loan_application_id, CASE WHEN o_orderkey % 60 <> 59 THEN o_custkey END AS entity_id, TRUE AS is_main_applicant,
               o_orderdate AS record_modified_at, o_custkey % 9 AS income_considered FROM {orders}
        UNION ALL
        SELECT o_orderkey, o_custkey + 1, FALSE, o_orderdate + INTERVAL 9 DAY, 77 FROM {orders} WHERE o_orderkey % 3 = 0""",
    "slv_asset": """
        SELECT CASE WHEN o_orderkey % 5 <> 4 THEN o_orderkey ELSE -o_orderkey END AS loan_application_id,
               CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_negative_area
        FROM {orders}
        UNION ALL SELECT o_orderkey, o_custkey % 2 = 0 FROM {orders} WHERE o_orderkey % 4 = 0""",
    "slv_employee": """
        SELECT s_suppkey AS employee_id, CAST(s_nationkey AS INT) AS base_branch_id, s_suppkey % 9 <> 8 AS is_active,
               CASE s_suppkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'n' WHEN 2 THEN ' false' END AS is_resigned,
               CASE s_suppkey % 3 WHEN 0 THEN 'Fos' WHEN 1 THEN 'clerk' END AS designation_name FROM {supplier}
        UNION ALL
        SELECT s_suppkey, CAST(s_nationkey AS INT), s_suppkey % 9 <> 8, NULL, 'Fos' FROM {supplier} WHERE s_suppkey % 6 > 2 AND s_suppkey % 3 = 0""",
    "slv_channel_partner": """SELECT s_suppkey AS dsa_id, CASE WHEN s_suppkey % 8 <> 7 THEN CAST(s_nationkey AS BIGINT) END AS base_location_branch_id FROM {supplier}""",
    "slv_early_warning": """
        SELECT o_orderkey + 100000000 AS ews_id,
               CAST(CASE WHEN o_orderkey % 5 < 3 THEN o_orderkey ELSE -o_orderkey END AS VARCHAR(20)) AS loan_application_id, DATE '1998-05-31' AS signal_date,
               'MONTH_END' AS snapshot_type, CAST(o_custkey % 60 AS INT) AS ews_risk_score FROM {orders}
        UNION ALL
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR(20)), DATE '1998-04-30', 'MONTH_END', 99 FROM {orders} WHERE o_orderkey % 5 < 4
        UNION ALL
        SELECT o_orderkey + 200000000, CAST(o_orderkey AS VARCHAR(20)), DATE '1998-06-15', 'CURRENT_DAY', 1 FROM {orders} WHERE o_orderkey % 5 = 0
        UNION ALL
        SELECT o_orderkey + 300000000, CAST(o_orderkey AS VARCHAR(20)), DATE '1998-06-30', 'MONTH_END', 2 FROM {orders} WHERE o_orderkey % 10 = 3""",
}


def source_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables.from_folder(spark, sf_dir, ".parquet")


def raw_tables(spark: SparkSession, sf_dir: str, sources: Tables | None = None) -> Tables:
    """The derived raw tables as Spark frames, each built when first used."""
    sources = sources or source_tables(spark, sf_dir)

    def load(name: str) -> DataFrame:
        text = RAW[name].replace(_PS, _PS_WIDE)
        used = {s: sources[s] for s in SOURCES if "{" + s + "}" in text}
        used |= {n: tables[n] for n in RAW if "{" + n + "}" in text}
        return spark.sql(text, **used)

    tables = Tables(load)
    return tables


def raw_sql(*names: str) -> str:
    """The named raw tables as leading SQL clauses: 'WITH a AS (...), b AS (...)'."""
    plain = {s: s for s in (*SOURCES, *RAW)}
    return "WITH " + ",\n".join(f"{n} AS (\n{RAW[n].format(**plain)})" for n in names)
