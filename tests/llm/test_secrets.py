import base64
import math
import random
import re

import pytest

from loanfold.llm import secrets
from tests.llm.helpers import documents

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def texts():
    rng = random.Random(4)
    bits = ["token=", "PassWD : '", "api_key:", "ApiKey =", "secret:", "ſecret=abcdefghijklmn", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef",
            "abcdef", "0123456789", "x", " ", "é", "😀", "=", ":", "\"", "longenough_12", "AbC/dEf+123=", "\n", "g"]
    return ["".join(rng.choices(bits, k=rng.randrange(0, 40))) for _ in range(300)]


def test_base_spans_as_by_brute_force(spark):
    rows = list(enumerate(texts())) + [(500, None), (501, ""), (None, "token=0123456789abcdef"), (None, None), (3, texts()[3]),
                                       (502, "token: secret:abcdefghijklmnop"), (503, "é😀 0123456789abcdef " * 3000)]
    found = secrets.secrets(documents(spark, rows, extra=True)).collect()
    mine = sorted(((r.doc_id, [(s.start, s.kind, s.end) for s in r.found if s.kind < 3]) for r in found), key=repr)
    assert mine == sorted(((i, plain(t)) for i, t in rows), key=repr)


def plain_battery(token):
    token = token.rstrip("=").translate(str.maketrans("-_", "+/"))
    name = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token) else "base32" if re.fullmatch("[A-Z2-7]+", token) else "base64"
    letters = secrets.ALPHABETS[name]
    codes = [letters.index(c) for c in (token.lower() if name == "hex" else token)]
    n, k = len(codes), len(letters)

    def tail(z):
        return math.erfc(z / math.sqrt(2)) / 2

    chi = k / n * sum(codes.count(c) ** 2 for c in range(k)) - n
    high = sum(2 * c >= k for c in codes)
    both = 2 * high * (n - high)
    variance = both * (both - n) / (n * n * (n - 1))
    runs = 1 + sum((2 * a >= k) != (2 * b >= k) for a, b in zip(codes, codes[1:]))
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    lag = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    z = [(chi - k + 1) / math.sqrt(2 * (k - 1) * (n - 1) / n),
         abs(runs - both / n - 1) / math.sqrt(variance) if variance > 0 else 12,
         abs(lag / spread + 1 / n) * math.sqrt(n) if spread else 12]
    h = -sum(math.log(max(1e-30, p)) for p in (tail(z[0]), 2 * tail(z[1]), 2 * tail(z[2])))
    excess = k * secrets.SAME[name] - 1
    even = (k - 1 + (n - 1) * excess - chi) / math.sqrt(2 * (k - 1) + 4 * n * excess)
    return name, min(12, int(math.log2(n))), math.exp(-h) * (1 + h + h * h / 2), max(1e-30, tail(even))


def test_battery_as_by_plain_arithmetic(spark):
    rng = random.Random(8)
    tokens = [rng.randbytes(20).hex(), rng.randbytes(20).hex().upper(), base64.b32encode(rng.randbytes(20)).decode(),
              base64.b64encode(rng.randbytes(31)).decode(), base64.urlsafe_b64encode(rng.randbytes(200)).decode(),
              "thisisalongwordwithoutspaces", "a" * 30, "01" * 15, "ABABABABABABABABABAB", "x" * 6000]
    df = spark.createDataFrame([(tokens,)], "t array<string>")
    found = df.select(secrets.battery(df.t).alias("b")).first().b
    for token, r in zip(tokens, found):
        name, band, uniform, text = plain_battery(token)
        assert (r.encoding, r.band) == (name, band)
        assert r.random == pytest.approx(uniform, rel=2e-2, abs=1e-7) and r.text == pytest.approx(text, rel=0.5, abs=1e-7)


def test_random_keys_are_discovered_and_words_are_not(spark):
    rng = random.Random(9)
    rows, keys = [], {}
    for i in range(200):
        word = "".join(rng.choices(["ment", "ation", "ing", "the", "ver", "lich"], k=9))
        key = base64.b64encode(rng.randbytes(36)).decode() if i % 4 == 0 else ""
        keys[i] = key
        rows.append((i, f"{word} and {key} then {word.upper()}"))
    docs = documents(spark, rows, extra=True)
    texts = dict(rows)
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.found if s.kind == 3] for r in secrets.secrets(docs).collect()}
    assert sum(keys[i] in found[i] for i in found if keys[i]) >= 48
    assert sum(bool(set(found[i]) - {keys[i]}) for i in found) <= 2
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r.text == (texts[r.doc_id].replace(keys[r.doc_id], "[SECRET]") if found[r.doc_id] else texts[r.doc_id])
        assert r.n_chars == len(r.text)


def test_redaction_of_base_kinds(spark):
    rows = list(enumerate(texts())) + [(400, None), (401, "")]
    kept = {r.doc_id: r.text for r in secrets.redacted(documents(spark, rows), q=0.0).collect()}  # q 0: no discovery
    assert kept[400] is None and kept[401] == ""
    for i, t in rows[:300]:
        t = ASSIGN.sub(lambda m: "[SECRET]" if len(m[1]) >= 12 else m[0], t)
        assert kept[i] == re.sub("[0-9a-f]{16,}", "[SECRET]", re.sub("AKIA[A-Z0-9]{14,}", "[SECRET]", t))


def test_empty_table(spark):
    assert secrets.secrets(documents(spark, []).filter("false")).collect() == []


def test_running_totals(spark):
    for n in (0, 1, 2, 7, 1000):
        df = spark.createDataFrame([(list(range(n)),)], "a array<int>")
        got = df.select(secrets.running(df.a, lambda a, b: a + b).alias("s")).first().s
        assert got == [i * (i + 1) // 2 for i in range(n)]
