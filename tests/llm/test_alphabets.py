"""The battery on uniform draws from the alphabets in which keys are written."""

import math
import random
import re
from string import ascii_lowercase as low
from string import digits

import pytest
from pyspark.sql import functions as F

from talkweave.llm import secret_scan

ALPHABETS = {"base 36": low + digits, "BASE 36": low.upper() + digits, "base 32": low + "234567", "BASE 32": low.upper() + "234567", "base 58": secret_scan.ENCODINGS[3][2], "base 62": low + low.upper() + digits}


def test_uniform_draws_look_random(spark):
    rng = random.Random(11)
    rows = [(name, n, "".join(rng.choices(a, k=n))) for name, a in ALPHABETS.items() for n in (32, 64, 100, 200) for _ in range(50)]
    df = spark.createDataFrame(rows, "name string, n int, t string").withColumn("b", secret_scan.battery(F.col("t")))
    found = df.groupBy("name", "n").agg(F.avg(secret_scan.looks_random(F.col("b")).cast("int")).alias("share")).collect()
    assert len(found) == 24 and min(r.share for r in found) >= 0.9, found


def plain_battery(t):
    """z values, p-values and score of a run, from their definitions."""
    core = t.rstrip("=")
    k, alphabet = next(((k, a) for k, p, a in secret_scan.ENCODINGS if re.fullmatch(p, core)), (64, secret_scan.ALPHABET))
    x = [alphabet.index(c) if c in alphabet else 63 for c in (core.lower() if k <= 36 else core)]
    if k == 64:
        x = [secret_scan.ALPHABET.index(c) for c in core]
    n, p = len(x), 1 / k
    pairs = sum(a == b for i, a in enumerate(x) for b in x[:i])
    two, three = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    sd = (two * p * (1 - p)) ** 0.5
    skew = (two * p * (1 - p) * (1 - 2 * p) + 6 * three * p * p * (1 - p)) / sd**3
    base = 1 + skew * (pairs - 0.5 - two * p) / sd / 2
    z = (math.copysign(abs(base) ** (1 / 3), base) - 1) * 6 / skew + skew / 6
    tail = lambda z: 0.5 * math.erfc(z / 2**0.5)
    m = (k - 1) / 2
    turns = sum((a > m) != (b > m) for a, b in zip(x, x[1:]))
    runs = min(1, 2 * tail((abs(turns - (n - 1) / 2) - 0.5) / ((n - 1) ** 0.5 / 2)))
    serial = min(1, 2 * tail(abs(sum((a - m) * (b - m) for a, b in zip(x, x[1:]))) / ((k * k - 1) / 12 * (n - 1) ** 0.5)))
    kind = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in (core.lower() if k <= 36 else core)]
    share = sum(a != b for a, b in zip(kind, kind[1:])) / (n - 1)
    kl = lambda s, r: sum(a * math.log(a / b) for a, b in ((s, r), (1 - s, 1 - r)) if a) if s > r else 0
    q, q3 = secret_scan.EQUAL[k > 36]
    few = min(0, (pairs + 0.5 - two * q) / (two * q * (1 - q) + 6 * three * (q3 - q * q)) ** 0.5)
    nats = max(n * kl(1, 0.35) if k == 16 else 0, (n - 1) * kl(share, 0.12), few * few / 2)
    return k, tail(z), runs, serial, max(0, (nats - math.log(3)) / math.log(10))


def drawn(rng):
    plainly = ["internationalizationandlocalization", "this_is_a_long_snake_case_name", "SomeCamelCaseIdentifierNameHere", "path/to/some/deep/folder/of/files", "a" * 28, "0000000000111111111122222222"]
    return plainly + ["".join(rng.choices(a, k=n)) for a in [*ALPHABETS.values(), "0123456789abcdef", secret_scan.ALPHABET[:-2]] for n in (20, 24, 40, 64, 130) for _ in range(4)]


def test_battery_equals_plain_python(spark):
    ts = drawn(random.Random(2))
    rows = spark.createDataFrame([(t,) for t in ts], "t string").select("t", secret_scan.battery(F.col("t")).alias("b")).collect()
    for r in rows:
        k, *rest = plain_battery(r.t)
        assert r.b.encoding == k
        assert [r.b.p_chi, r.b.p_runs, r.b.p_serial, r.b.score] == pytest.approx(rest, rel=1e-4, abs=1e-9), r.t


def test_tails_hold_at_every_length(spark):
    """Of uniform draws, about as many are rejected at a level as it says, by each test, in sparse cells too."""
    rng = random.Random(9)
    rows = [(n, "".join(rng.choices(a, k=n))) for n in (20, 40, 100) for a in (secret_scan.ALPHABET[:-2], "0123456789abcdef") for _ in range(2000)]
    df = spark.createDataFrame(rows, "n int, t string").select("n", secret_scan.battery(F.col("t")).alias("b"))
    for test in ("p_chi", "p_runs", "p_serial"):
        for r in df.groupBy("n").agg(F.avg((F.col(f"b.{test}") < 0.05).cast("int")).alias("five"), F.avg((F.col(f"b.{test}") < 0.003).cast("int")).alias("few")).collect():
            assert 0.01 <= r.five <= 0.09 and r.few <= 0.012, (test, r)


def benjamini_hochberg(scores):
    """The least score accepted, scores taken down to their bins; all runs count."""
    ps = sorted(10 ** -(min(s // secret_scan.BIN, secret_scan.BINS) * secret_scan.BIN) for s in scores)
    ok = [p for i, p in enumerate(ps, 1) if p <= secret_scan.ALPHA * i / len(ps)]
    return -math.log10(max(ok)) if ok else float("inf")


def test_thresholds_count_every_run_tested(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(20, 70))) for _ in range(300)]
    keys = ["".join(rng.choices(secret_scan.ALPHABET[:62], k=n)) for n in (24, 40, 80) for _ in range(20)] + ["".join(rng.choices(low + "234567", k=64)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(words + keys)), "doc_id bigint, text string")
    rows = {r.t: r.s for r in docs.select(F.col("text").alias("t"), F.when(secret_scan.looks_random(secret_scan.battery(F.col("text"))), secret_scan.battery(F.col("text"))["score"]).otherwise(0.0).alias("s")).collect()}
    of = lambda t: sum(len(t) >= x for x in secret_scan.LENGTHS) - 1
    limits = [benjamini_hochberg([s for t, s in rows.items() if of(t) == k]) for k in range(3)]
    found = {r.doc_id for r in secret_scan.scan(docs).collect() if any(x.kind == "random" for x in r.found)}
    assert found == {i for i, t in enumerate(words + keys) if rows[t] // secret_scan.BIN * secret_scan.BIN >= limits[of(t)] - 1e-9}
    assert sum(i < 300 for i in found) <= 2 and sum(300 <= i < 360 for i in found) >= 55 and sum(i >= 360 for i in found) >= 5  # of one case and with few digits, little tells them from writing


def test_a_random_run_without_capitals_is_found(spark):
    token = "".join(random.Random(8).choices(low + "234567", k=64))
    docs = spark.createDataFrame([(1, f"the key {token} is here internationalizationandlocalization")], "doc_id bigint, text string")
    assert secret_scan.scan(docs).select(secret_scan.listed(F.col("found")).alias("s")).first().s == "random:8:72"


def test_a_long_key_is_found_and_redacted(spark):
    token = "".join(random.Random(5).choices(low + digits, k=100))
    docs = spark.createDataFrame([(1, f"the key {token} is here")], "doc_id bigint, text string")
    assert secret_scan.scan(docs).select(secret_scan.listed(F.col("found")).alias("s")).first().s == "random:8:108"
    assert secret_scan.cleaned(docs).first().text == "the key [SECRET] is here"
