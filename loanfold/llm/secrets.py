"""Secret scans by built-in functions only: fixed patterns, and a battery of randomness tests on other long tokens."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import saved

KINDS = ("assign", "access", "hex", "random")
# The patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
#: Shortest token that the tests can tell from text, and the tokens they look at.
LEAST = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST
PATTERNS = (ASSIGN, ACCESS, HEX, TOKEN)
# Alphabets in the order of their codes.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Chance that two characters of readable text are the same: letters about 1/15, digits in hex 1/10.
SAME = {"hex": 0.1, "base32": 1 / 15, "base64": 1 / 15}
BINS_PER_DECADE = 4
LAST_BIN = 80
LAST_BAND = 12
DOUBLINGS = 28


def let(value: Column, body) -> Column:
    """body(value), the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, combine) -> Column:
    """Running totals of an array in log2(length) passes, each over the whole array."""

    def doubled(shift):
        return lambda a: F.when(F.size(a) > shift, F.concat(
            F.slice(a, 1, shift), F.zip_with(F.slice(a, shift + 1, F.size(a)), F.slice(a, F.lit(1), F.size(a) - shift), combine))).otherwise(a)

    for k in range(DOUBLINGS):
        values = let(values, doubled(1 << k))
    return values


def spans(text: Column, pattern: str, found: Column) -> Column:
    """(start, end) in code points of the matches that found lists, from the lengths of what stands between them."""
    between = F.slice(F.split(text, pattern), F.lit(1), F.size(found))
    steps = F.zip_with(between, found, lambda b, m: F.struct(F.length(m).alias("n"), (F.length(b) + F.length(m)).alias("step")))
    placed = let(steps, lambda s: F.zip_with(s, running(F.transform(s, lambda x: x["step"]), lambda a, b: a + b),
                                             lambda x, end: F.struct((end - x["n"]).alias("start"), end.alias("end"))))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def upper_tail(z: Column) -> Column:
    """Chance of a standard normal value above z, by a polynomial in 1 / (1 + 0.2316419 |z|)."""
    def tail(a):
        t = 1 / (1 + 0.2316419 * a)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, tail(F.abs(z))).otherwise(1 - tail(F.abs(z)))


def battery(tokens: Column) -> Column:
    """Tests on each token: (encoding, band, random, text).

    random: Fisher's combination of three p-values under uniform characters of the inferred encoding: too uneven an
    alphabet (chi-squared), too few or too many runs above and below the middle of the alphabet, and correlation of
    neighbours. text: chance that readable text of this length is as even as this token. Longer tokens can reach a
    smaller chance. band: logarithm of the length, base 2.
    """
    bare = F.transform(tokens, lambda t: F.translate(F.rtrim(t, F.lit("=")), "-_", "+/"))
    coded = F.transform(bare, lambda t: F.struct(
        t.alias("t"), F.when(t.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit("hex")).when(t.rlike("^[A-Z2-7]+$"), F.lit("base32"))
        .otherwise(F.lit("base64")).alias("encoding")))

    def per_encoding(encoding, values):
        return F.when(encoding == "hex", values["hex"]).when(encoding == "base32", values["base32"]).otherwise(values["base64"])

    spelt = F.transform(coded, lambda s: F.struct(
        F.when(s["encoding"] == "hex", F.lower(s["t"])).otherwise(s["t"]).alias("t"), s["encoding"].alias("encoding"),
        per_encoding(s["encoding"], {k: F.lit(v) for k, v in ALPHABETS.items()}).alias("letters")))
    counted = F.transform(spelt, lambda s: F.struct(
        s["encoding"].alias("encoding"), F.length(s["t"]).cast("double").alias("n"),
        F.length(s["letters"]).cast("double").alias("k"),
        F.aggregate(F.split(s["letters"], ""), F.lit(0.0), lambda total, c: total + F.pow(
            (F.length(s["t"]) - F.length(F.replace(s["t"], c, F.lit("")))).cast("double"), F.lit(2.0))).alias("squares"),
        F.transform(F.split(s["t"], ""), lambda c: F.call_function("instr", s["letters"], c) - 1.0).alias("codes")))
    moments = F.transform(counted, lambda s: F.struct(
        s["encoding"].alias("encoding"), s["n"].alias("n"), s["k"].alias("k"), s["squares"].alias("squares"),
        s["codes"].alias("codes"), (F.aggregate(s["codes"], F.lit(0.0), lambda a, x: a + x) / s["n"]).alias("mean"),
        F.aggregate(s["codes"], F.lit(0.0), lambda a, x: a + F.when(x * 2 >= s["k"], 1.0).otherwise(0.0)).alias("high"),
        F.zip_with(F.slice(s["codes"], F.lit(1), F.size(s["codes"]) - 1), F.slice(s["codes"], F.lit(2), F.size(s["codes"]) - 1),
                   lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("pairs")))
    figures = F.transform(moments, lambda s: F.struct(
        s["encoding"].alias("encoding"), s["n"].alias("n"), s["k"].alias("k"),
        (s["k"] / s["n"] * s["squares"] - s["n"]).alias("chi"), s["high"].alias("high"), (s["n"] - s["high"]).alias("low"),
        F.aggregate(s["pairs"], F.lit(1.0), lambda t, p: t + F.when(
            (p["a"] * 2 >= s["k"]) != (p["b"] * 2 >= s["k"]), 1.0).otherwise(0.0)).alias("runs"),
        F.aggregate(s["pairs"], F.lit(0.0), lambda t, p: t + (p["a"] - s["mean"]) * (p["b"] - s["mean"])).alias("lag"),
        F.aggregate(s["codes"], F.lit(0.0), lambda t, x: t + (x - s["mean"]) * (x - s["mean"])).alias("spread")))

    def scores(s):
        n, k, both = s["n"], s["k"], 2 * s["high"] * s["low"]
        variance = both * (both - n) / (n * n * (n - 1))
        excess = per_encoding(s["encoding"], {name: F.lit(len(letters) * SAME[name] - 1) for name, letters in ALPHABETS.items()})
        return F.struct(
            s["encoding"].alias("encoding"), n.alias("n"),
            ((s["chi"] - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)).alias("uneven"),
            F.when(variance > 0, F.abs(s["runs"] - both / n - 1) / F.sqrt(variance)).otherwise(12.0).alias("runs"),
            F.when(s["spread"] > 0, F.abs(s["lag"] / s["spread"] + 1 / n) * F.sqrt(n)).otherwise(12.0).alias("lag"),
            (((k - 1) + (n - 1) * excess - s["chi"]) / F.sqrt(2 * (k - 1) + 4 * n * excess)).alias("even"))

    def chances(s):
        parts = F.array(upper_tail(s["uneven"]), 2 * upper_tail(s["runs"]), 2 * upper_tail(s["lag"]))
        h = F.aggregate(parts, F.lit(0.0), lambda t, p: t - F.log(F.greatest(p, F.lit(1e-30))))
        return F.struct(s["encoding"].alias("encoding"),
                        F.least(F.floor(F.log2(s["n"])), F.lit(LAST_BAND)).cast("int").alias("band"),
                        let(h, lambda x: F.exp(-x) * (1 + x + x * x / 2)).alias("random"),
                        F.greatest(upper_tail(s["even"]), F.lit(1e-30)).alias("text"))

    return F.transform(F.transform(figures, scores), chances)


def bin_of(test: Column, alpha: float) -> Column:
    """Strength of a token's case, in steps of -log10 of its text chance; 0 where the tests reject randomness."""
    steps = F.least(F.floor(-F.log10(test["text"]) * BINS_PER_DECADE), F.lit(LAST_BIN)).cast("int")
    return F.when(test["random"] >= alpha, F.greatest(steps, F.lit(0))).otherwise(0)


def scanned(docs: DataFrame, keep: list[str], alpha: float = 0.001) -> DataFrame:
    """Columns to keep, and arrays of spans: assign, access, hex, and random with each token's (encoding, band, bin)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(*keep, text.alias("_text"),
                        *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"_{k}") for k, p in zip(KINDS, PATTERNS)])
    good = F.transform(F.col("_assign"), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12)
    assign = F.filter(F.zip_with(spans(F.col("_text"), ASSIGN, F.col("_assign")), good, lambda s, ok: F.when(ok, s)), lambda s: s.isNotNull())
    tested = F.when(F.size("_random") > 0, F.transform(battery(F.col("_random")), lambda t: F.struct(
        t["encoding"].alias("encoding"), t["band"].alias("band"), bin_of(t, alpha).alias("bin"))))
    random = F.zip_with(spans(F.col("_text"), TOKEN, F.col("_random")), tested, lambda s, t: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), t["encoding"].alias("encoding"), t["band"].alias("band"), t["bin"].alias("bin")))
    empty = F.array().cast("array<struct<start:int,end:int,encoding:string,band:int,bin:int>>")
    return found.select(*keep, assign.alias("assign"), spans(F.col("_text"), ACCESS, F.col("_access")).alias("access"),
                        spans(F.col("_text"), HEX, F.col("_hex")).alias("hex"),
                        F.when(F.size("_random") > 0, random).otherwise(empty).alias("random"))


def least_bins(tokens: DataFrame, q: float) -> dict[tuple[str, int], int]:
    """The weakest bin that still counts as a discovery, per encoding and band (Benjamini-Hochberg at rate q).

    tokens: one row (encoding, band, bin) per token of all documents. Only counts per encoding, band and bin are
    ranked, at most 3 x 12 x 81 rows whatever the corpus holds, and one row per encoding and band reaches the driver.
    """
    counts = tokens.groupBy("encoding", "band", "bin").agg(F.count(F.lit(1)).alias("n"))
    stratum = Window.partitionBy("encoding", "band")
    stronger = stratum.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("encoding", "band", "bin", F.sum("n").over(stratum).alias("all"), F.sum("n").over(stronger).alias("at_least"))
    chance = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS_PER_DECADE)))
    kept = ranked.filter((F.col("bin") > 0) & (F.col("all") * chance <= q * F.col("at_least")))
    return {(r.encoding, r.band): r.bin for r in kept.groupBy("encoding", "band").agg(F.min("bin").alias("bin")).collect()}


def discovered(token: Column, least: dict[tuple[str, int], int]) -> Column:
    """Whether a token (encoding, band, bin) is a discovery."""
    needed = F.lit(LAST_BIN + 1)
    for (encoding, band), weakest in sorted(least.items()):
        needed = F.when((token["encoding"] == encoding) & (token["band"] == band), weakest).otherwise(needed)
    return token["bin"] >= needed


def secrets(docs: DataFrame, q: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """Secrets of each document: doc_id, and found, an array of (start, kind, end) by start, then kind.

    kind counts from 0 in the order of KINDS. Offsets are code points, the end exclusive. Base spans follow the fixed
    patterns, leftmost and without overlap in each kind. A random span is a token of LEAST or more characters that the
    tests do not tell from random characters and that is, within its encoding and length, too even for text at a false
    discovery rate of q over the tokens of all documents.

    NULL text is empty and has none. Every row is scanned by itself, so repeated and NULL doc_ids stay rows of their
    own. Other columns are ignored. An empty table gives no rows.
    """
    seen = saved(scanned(docs, ["doc_id"], alpha), "scanned")
    least = least_bins(seen.select(F.explode("random").alias("t")).select("t.*"), q)

    def listed(name: str, number: int) -> Column:
        return F.transform(F.col(name), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))

    tokens = F.transform(F.filter("random", lambda t: discovered(t, least)), lambda s: F.struct(
        s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    every = F.concat(*[listed(k, i) for i, k in enumerate(KINDS[:3])], tokens)
    return seen.select("doc_id", F.array_sort(every).alias("found"))


def listing(found: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.filter(found, lambda s: s["kind"] < 3) if base_only else found
    return F.array_join(F.transform(shown, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def rewritten(text: Column, pattern: str, judge, mark: str) -> Column:
    """The text with matches replaced by mark where judge(matches), an array of booleans, says so."""
    def rebuilt(both):
        pieces, found, wrong = both["pieces"], both["found"], both["wrong"]
        said = F.zip_with(found, wrong, lambda m, w: F.when(w, F.lit(mark)).otherwise(m))
        parts = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), said, lambda b, m: F.concat(b, m))
        return F.concat(F.array_join(parts, ""), F.element_at(pieces, -1))

    def checked(t, m):
        return F.when(F.size(m) > 0, let(
            F.struct(F.split(t, pattern).alias("pieces"), m.alias("found"), judge(m).alias("wrong")), rebuilt)).otherwise(t)

    return let(text, lambda t: let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: checked(t, m)))


def redacted(docs: DataFrame, q: float = 0.05, alpha: float = 0.001, mark: str = "[SECRET]") -> DataFrame:
    """All documents and columns with secrets replaced by mark, kind after kind; n_chars, where there is one, follows.

    The corpus is scanned once for the discovery limits and once for the texts.
    """
    tokens = scanned(docs, [], alpha).select(F.explode("random").alias("t")).select("t.*")
    least = least_bins(tokens, q)
    always = lambda m: F.transform(m, lambda x: F.lit(True))
    judges = (
        lambda m: F.transform(m, lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= 12), always, always,
        lambda m: F.transform(battery(m), lambda t: discovered(F.struct(
            t["encoding"].alias("encoding"), t["band"].alias("band"), bin_of(t, alpha).alias("bin")), least)))
    text = F.col("text")
    for pattern, judge in zip(PATTERNS, judges):
        text = rewritten(text, pattern, judge, mark)
    clean = docs.withColumn("text", text)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean
