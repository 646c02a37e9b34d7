"""Columns of the silver tables as the checking SQL names them, written out apart from the builds.

Pairs read 'source column AS name'; code columns are given as output name -> (source alias, code column).
"""

LOAN_APPLICATION = """
    x.salesforceid AS salesforce_id, x.leadid AS lead_id, x.loanproductid AS product_id, x.refinanceschemeid AS scheme_id, x.firstsanctiondate AS
    first_sanction_date, x.lastsanctiondate AS last_sanction_date, x.loanamountrequest AS requested_amount, x.firstsanctionamount AS
    first_sanction_amount, x.revisedsanctionamount AS revised_sanction_amount, x.tenure AS requested_tenure_months, x.sanctionedtenure AS
    sanctioned_tenure_months, x.sanctionedemi AS sanctioned_emi, x.statustypedetailid AS loanstatus_typedetail_id, x.channelpartnerdsaid AS
    channel_partner_dsa_id, x.salesofficerempid AS sales_officer_emp_id, x.creditofficerempid AS credit_officer_emp_id, x.createdon AS
    record_created_at, x.lastmodifiedon AS record_modified_at"""

LOAN_DISBURSAL = """
    ds.fleno AS file_number, ds.emistartdate AS emi_start_date, ds.emienddate AS emi_end_date, ds.documentvalue AS document_value, ds.emicycle AS
    emi_cycle_day, ds.hypothecation AS hypothecation_detail"""

LOAN_DISBURSAL_RATIOS = """
    CAST(ds.ltv AS DECIMAL(10,2)) AS dltv, CAST(ds.ltvwithinsurance AS DECIMAL(10,2)) AS dltv_with_insurance, CAST(ds.lcr AS DECIMAL(10,2)) AS dlcr,
    CAST(ds.lcrwithinsurance AS DECIMAL(10,2)) AS dlcr_with_insurance, CAST(ds.combineddltv AS DECIMAL(10,2)) AS combined_dltv, CAST(ds.combineddlcr
    AS DECIMAL(10,2)) AS combined_dlcr"""

LOAN_ADDITIONAL = """
    lad.firstdisbursementdate AS first_disbursal_date, lad.lastdisbursementdate AS last_disbursal_date, lad.disbursedamounttilldate AS
    total_disbursed_amount, lad.bookedamounttilldate AS total_booked_amount, lad.totalinsuranceamount AS total_insurance_amount, lad.inorganictype AS
    inorganic_type, lad.firstbookeddate AS first_booked_date, lad.lastbookeddate AS last_booked_date, lad.firstbookedamount AS first_booked_amount,
    lad.isfullybooked AS is_fully_booked, lad.loanadditionalid AS loan_additional_id, lad.zoneid AS zone_id, lad.regionid AS region_id,
    lad.loginamount AS login_amount, lad.firstdisbursedamount AS first_disbursed_amount, lad.loandownsizedate AS loan_downsize_date,
    lad.isactuallyfullydisbursed AS is_actually_fully_disbursed, lad.currentroi AS current_roi, lad.currenttenor AS current_tenure, lad.balancetenor
    AS balance_tenure, lad.sanctionltv AS sanction_ltv, lad.taggedwith AS tagged_with, lad.otcpending AS otc_pending, lad.pddpending AS pdd_pending,
    lad.titlereasontypedetailid AS titlereason_typedetailid, lad.titledeedreceivedate AS title_deed_receive_date, lad.pddstatustypedetailid AS
    pddstatus_typedetailid, lad.otcstatustypedetailid AS otcstatus_typedetailid, lad.titledeedstatustypedetailid AS title_deed_status_typedetailid,
    lad.pendingchequehandovercount AS pending_cheque_handover_count, lad.pendingchequehandoveramount AS pending_cheque_handover_amount, lad.isactive
    AS is_active, lad.createdby AS created_by, lad.lastmodifiedby AS last_modified_by, lad.frauddetectiondate AS fraud_detection_date, lad.fraudtype
    AS fraud_type, lad.preferredlanguagetypedetailid AS preferred_language_typedetailid, lad.digitalteamempid AS digital_team_emp_id, lad.branchid AS
    branch_id, lad.branchname AS branch_name, lad.regionname AS region_name, lad.zonename AS zone_name, lad.salesofficername AS
    sales_officer_emp_name_code, lad.salesofficerdesignation AS sales_officer_designation, lad.salesofficerdesignationlevel AS
    sales_officer_designation_level"""

LOAN_SPREAD = """
    s.baserateinpercentage AS base_rate_pct, s.plrspreadinpercentage AS plr_spread_pct, s.finalroi AS final_roi_pct, s.waiverroiinpercentage AS
    waiver_roi_pct, s.additionalspread AS add_spread"""

LOAN_DECISION = """
    dec.loanofferamount AS eligible_loan_amount, dec.proposedemi AS proposed_emi, dec.proposedtenor AS proposed_tenor, dec.incomeconsidered AS
    income_considered, dec.obligationconsidered AS obligation_considered, dec.propertyvalue AS property_value_considered, dec.finalfoir AS
    final_foir_pct, dec.finalltv AS final_ltv_pct, dec.combinedltv AS combined_ltv_pct, dec.insr AS insr_pct, dec.foirnorm AS foir_norm, dec.ltvnorm
    AS ltv_norm"""

APPLICANT = """
    x.entityid AS entity_id, x.parentapplicantid AS parent_applicant_id, x.age AS age, x.incomeconsidered AS income_considered, x.nameasperaadhar AS
    name_as_per_aadhar, x.risktypedetailid AS risk_typedetailid, x.noofpropertyowned AS no_of_propertyowned, x.createdon AS record_created_at,
    x.lastmodifiedon AS record_modified_at"""

APPLICANT_KYC = """
    ky.pan_identificationnumber AS pan_number, ky.pan_kyc_verified_status AS pan_kyc_verified_status, ky.aadh_refuid AS aadhaar_token,
    ky.aadh_kyc_verified_status AS aadh_kyc_verified_status, ky.aadh_uidlastdigit AS uid_last_digit, ky.voter_identificationnumber AS voter_id,
    ky.voter_kyc_verified_status AS voter_kyc_verified_status, ky.pass_identificationnumber AS passport_number, ky.pass_kyc_verified_status AS
    pass_kyc_verified_status, ky.dl_identificationnumber AS driving_license_number, ky.dl_kyc_verified_status AS dl_kyc_verified_status"""

APPLICANT_ADDRESS = """
    ad.cityname AS current_city, ad.zip AS current_pincode, ad.address1 AS primary_address, ad.cityid AS city_id, ad.districtid AS district_id,
    ad.landmark AS address_landmark, ad.blocktaluka AS block_taluka, ad.stayinginyears AS staying_in_years"""

APPLICANT_OCCUPATION = """
    occ.retirementage AS retirement_age, occ.designation AS designation, occ.gstregistration AS gst_vat, occ.dateofjoining AS date_of_joining,
    occ.totalexperience AS total_experience, occ.businessvinatgeinyear AS business_vinatge_in_year, occ.businesssetuptypedetailid AS
    business_setup_typedetailid, occ.ispensioner AS is_pensioner, occ.issalaryslipavailable AS is_salary_slip_available, occ.ismultipleearner AS
    is_multiple_earner"""

APPLICANT_LABELS = {
    "gender": ("x", "gendertypedetailid"),
    "marital_status": ("x", "maritialstatustypedetailid"),
    "nationality": ("x", "nationalitytypedetailid"),
    "religion": ("x", "religiontypedetailid"),
    "caste_category": ("x", "castetypedetailid"),
    "_relation": ("x", "relationshiptypedetailid"),
    "qualification": ("x", "qualificationtypedetailid"),
    "detailed_qualification": ("x", "detailqualificationtypedetailid"),
    "current_risk": ("rk", "risk"),
    "profile_segment": ("occ", "profilesegmenttypedetailid"),
    "sub_profile": ("occ", "subprofiletypedetailid"),
    "occupation": ("occ", "nhbqoccupationtypedetailid"),
    "distinct_occupation": ("occ", "occupationsubtypedetailid"),
    "constitution": ("occ", "constitutiontypedetailid"),
    "industry": ("occ", "industrytypedetailid"),
    "sub_industry": ("occ", "subindustrytypedetailid"),
    "employment_type": ("occ", "employmenttypedetailid"),
    "sector_constitution": ("occ", "sectortypedetailid"),
    "address_type": ("ad", "addresstypedetailid"),
    "residence_type": ("ad", "residencetypetypedetailid"),
    "kyc_status": ("ks", "verifiedstatustypedetailid"),
}

MONTHLY = """
    m.loanmonthlyid AS loan_monthly_id, m.loanapplicationid AS loan_application_id, m.pos AS pos, m.sellpos AS sell_pos, m.dueinterest AS
    due_interest, m.dueprinciple AS due_principal, m.previousdue AS previous_due, m.outstandinginsurance AS outstanding_insurance,
    m.accuredinterestnotdue AS accrued_interest_notdue, m.maxdeliquencyday AS max_dpd, m.isnpa AS is_npa, m.npastartdate AS npa_start_date,
    m.assetclassification AS asset_classification, m.statustypedetailid AS loanstatus_typedetail_id, m.provisionsvalue AS provisions_value,
    m.riskweight AS risk_weight, m.sourcefundingname AS source_funding_name, m.liabilitycode AS liability_code, m.roi AS roi,
    m.assetclassificationdate AS asset_classification_date, m.currentltv AS current_ltv, m.fixedstartdate AS fixed_start_date, m.collectionstatus AS
    collection_status, m.presentationstatus AS presentation_status, m.collectionbkt AS collection_bkt, m.fixedduration AS fixed_duration,
    m.summarymonth AS summary_month, m.summaryyear AS summary_year, m.balancetenor AS balance_tenur, m.createdon AS record_created_at,
    m.lastmodifiedon AS record_modified_at"""

PROPERTY = """
    x.applicantpropertydetailid AS property_detail_id, x.unittypetypedetailid AS unit_type_typedetailid, x.propertytypedetailid AS
    property_type_typedetailid, x.ownershiptypedetailid AS ownership_type_typedetailid, x.natureofpropertytransactiontypedetailid AS
    nature_of_transaction_typedetailid, x.endusetypedetailid AS end_use_typedetailid, x.propertydocumenttypedetailid AS
    property_document_type_typedetailid, x.alreadyownedpropertytypedetailid AS already_owned_property_typedetailid, x.createdon AS record_created_at,
    x.lastmodifiedon AS record_modified_at"""

PROPERTY_FACTS = """
    sur.parentpropertyid AS parent_property_id, sur.pacolonyprojectname AS tech_project_name, sur.pakhasrasurveyno AS tech_khasra_survey_no,
    ds.landplotrate AS agreement_land_rate_per_sqft, ds.existingconstructionbuiltuprate AS agreement_buildup_existing_rate_per_sqft,
    ds.proposedconstructionbuiltuprate AS agreement_buildup_proposed_rate_per_sqft, ds.constructionsuperbuiltuprate AS
    agreement_super_buildup_rate_per_sqft, vet.classificationtypedetailid AS property_classification_typedetailid, vet.urbanruraltypedetailid AS
    urban_rural_typedetailid, vet.transitiontypedetailid AS transaction_type_typedetailid, leg.legaldetailstatustypedetailid AS
    legal_report_status_typedetailid, leg.advocatename AS legal_advocate_name, leg.cityid AS legal_city, leg.districtid AS legal_district, leg.stateid
    AS legal_state, leg.pincode AS legal_pincode, lf.reportreceiveddate AS legal_report_date, lf.agencyid AS legal_agency_id,
    lf.legalfiringstatustypedetailid AS legal_firing_status_typedetailid, lf.firingdate AS legal_firing_date, lf.isrefire AS legal_is_refire,
    lf.isrefiringdate AS legal_is_refiring_date, tf.agencyid AS tech_agency_id, tf.reportreceiveddate AS report_date, tf.reportfiringtypedetailid AS
    tech_firing_type_typedetailid, val.valuationbuiltupareaproposedratepersquarefeet AS buildup_proposed_rate_per_sqft,
    val.valuationsuperbuiltuparearatepersquarefeet AS super_buildup_rate_per_sqft, val.valuationcarpetarea AS carpet_area,
    val.valuationcarpetarearatepersquarefeet AS carper_area_rate"""

PROPERTY_LABELS = {
    "unit_type": ("x", "unittypetypedetailid"),
    "property_type": ("x", "propertytypedetailid"),
    "ownership_type": ("x", "ownershiptypedetailid"),
    "nature_of_transaction": ("x", "natureofpropertytransactiontypedetailid"),
    "end_use": ("x", "endusetypedetailid"),
    "property_document_type": ("x", "propertydocumenttypedetailid"),
    "already_owned_property": ("x", "alreadyownedpropertytypedetailid"),
    "property_classification": ("vet", "classificationtypedetailid"),
    "urban_rural": ("vet", "urbanruraltypedetailid"),
    "transaction_type": ("vet", "transitiontypedetailid"),
    "legal_report_status": ("leg", "legaldetailstatustypedetailid"),
    "legal_firing_status_description": ("lf", "legalfiringstatustypedetailid"),
    "tech_firing_type": ("tf", "reportfiringtypedetailid"),
}

LEGAL_ADDRESS = """
    houseno floorno wingno buildingno plotno surveyno streetno stageno landmark village mouza""".split()

RENEWAL = """
    r.dsacode AS dsa_code, r.companyname AS partner_name, r.iscorporate AS is_corporate, r.standardpayout AS is_standard_payout, r.contractstartdate
    AS contract_start_date, r.contractenddate AS contract_end_date, r.typeoforganisationtypedetailid AS type_of_organisation_type_detail_id,
    r.iskycdetailverified AS is_kyc_detail_verified, r.isreportverified AS is_report_verified, r.isfiverified AS is_fi_verified, r.iscibilverified AS
    is_cibil_verified, r.isfcuverified AS is_fcu_verified, r.isagreementverified AS is_agreement_verified, r.ispayoutannexureverified AS
    is_payout_annexure_verified, r.createdon AS record_created_at, r.lastmodifiedon AS record_modified_at"""

REQUEST = """
    q.typeoforganisationtypedetailid AS organisation_type_id, q.occupationtypedetailid AS occupation_type_detail_id"""

PAID = """
    s.payscheduleid AS pay_schedule_id, s.loanapplicationid AS loan_application_id, s.head AS head, s.duedate AS due_date, s.dueamount AS due_amount,
    s.principal AS principal, s.interst AS interest, s.closingbalance AS closing_balance, s.applicableroi AS applicable_roi, s.paymentreceiveddate AS
    payment_received_date, s.delinquentdays AS delinquent_days, s.clearenceflag AS clearence_flag, a.paytype AS paytype,
    COALESCE(a.presentationdetailid, a.receiptid) AS id"""

BRANCH_QUALITY = """
    active_loan_count total_pos total_pos_after_sell sma0_count sma1_count sma2_count npa_sub_standard_count doubtful1_count doubtful2_count
    doubtful3_count dpd_count npa_count""".split()

BRANCH_ACTIVITY = """
    total_logins total_loans_sanctioned total_loans_booked total_loans_disbursed total_loans_disbursal_cancelled""".split()
