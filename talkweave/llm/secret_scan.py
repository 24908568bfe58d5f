"""Secret scans: pattern matches with their places, and a randomness test battery for strings without a pattern.

Base spans are the matches of three patterns (``KINDS``), leftmost and non-overlapping per kind. The battery takes every
run of ``LEAST`` key characters that touches no base span and infers its encoding (``ENCODINGS``, the first that
has all its characters). Three p-values test it against uniform draws from that alphabet: chi-squared uniformity, by the
number of equal pairs, whose first three moments are exact at every length (a Pearson curve, as cells are sparse); runs
about the middle of the alphabet; lag-one serial correlation. A run whose smallest of three is under ``REJECT / 3``
(Bonferroni) isn't uniform. Against the chance that an ordinary identifier looks so, every run has a p-value from what the
same statistics bound under ordinary writing, the smallest of three times three: that all of it is hexadecimal, that
the character class changes so often, that so few pairs are equal. It falls with the length. A run that isn't uniform has
p-value 1. The Benjamini-Hochberg procedure, run per class of lengths over all runs tested in all documents, then holds
the share of false discoveries under ``ALPHA``.

All of it is built-in SQL. Only numbers leave the text: a table of spans per document is staged in the shared
folder, the p-values are counted in a fixed number of bins, and the thresholds (one per length class) are literals.
Null text counts as empty; empty texts and empty tables have no spans; repeated rows are scanned one by one. ``scan``
returns the key columns it is told and its own two, ``cleaned`` the columns of its input, so other columns never
clash. Places count code points from 0, ends are exclusive. A run, and the spans of a text, take time in proportion to
their length and number: one run of a megabyte takes some 6 seconds, ten megabytes with 450,000 spans 42.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, staged

#: The patterns of the base kinds, in the order in which ties at one place are listed.
#: A hexadecimal or access match is a maximal run, so its least length can stand in the pattern itself;
#: an assigned value's can't, since a failing match still uses up its characters.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
ASSIGNED_LEAST = 6

LEAST = 20
RANDOM = rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_"
#: Alphabets by size, each with the pattern of its runs; up to 36 letters are of one case and read as lower-case.
ENCODINGS = (
    (16, "[0-9a-f]+|[0-9A-F]+", ALPHABET[:16]), (32, "[a-z2-7]+|[A-Z2-7]+", "abcdefghijklmnopqrstuvwxyz234567"), (36, "[0-9a-z]+|[0-9A-Z]+", ALPHABET[:36]),
    (58, "[1-9A-HJ-NP-Za-km-z]+", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"), (62, "[0-9A-Za-z]+", ALPHABET[:62]),
)

ALPHA = 0.01
REJECT = 0.003
#: Of ordinary writing: the share of characters in 0-9a-f, the share at which the class changes, and the chances that
#: two and three characters are equal, in writing of one case and of both.
HEX_SHARE, CHANGE_SHARE = 0.35, 0.12
EQUAL = {False: (0.065, 0.0055), True: (0.045, 0.003)}
#: Lower ends of the length classes, and the bins of -log10(p).
LENGTHS = (20, 32, 64)
BIN, BINS = 0.25, 160

SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int>>"


#: Running totals are taken in blocks of so many, so that a text with very many matches costs no square of their number,
#: and texts are cut in blocks of so many characters, so that a place in a long text is found without walking to it.
BLOCK, CHARACTERS = 128, 4096


def _larger(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def _running(steps: Column, body, zero: Column | None = None, combine=lambda x, y: x + y) -> Column:
    """``body(upto)``, where ``upto(i)`` combines the steps from the first to the one at ``i``: their sum, if not told otherwise."""
    zero = F.lit(0) if zero is None else zero
    total = lambda a: F.aggregate(a, zero, combine)
    block = lambda i: F.floor(i / F.lit(BLOCK)).cast("int")

    def of_steps(t: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), block(F.size(t))), lambda j: total(F.slice(t, j * BLOCK + 1, BLOCK)))

        def of_sums(s: Column) -> Column:
            before = F.transform(s, lambda _, j: total(F.slice(s, F.lit(1), j)))
            return let(before, lambda b: body(lambda i: combine(F.get(b, block(i)), total(F.slice(t, block(i) * BLOCK + 1, i % BLOCK + 1)))))

        return let(sums, of_sums)

    return let(steps, of_steps)


def _matches(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Spans of all matches. Between two matches lies a piece of split(), so lengths add up to places."""
    p = F.lit(pattern)
    found = F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("s"), F.regexp_extract_all(text, p, F.lit(group)).alias("g"))
    no = F.lit(KINDS.index(kind) if kind in KINDS else len(KINDS))

    def spans(f: Column) -> Column:
        def each(upto) -> Column:
            place = lambda m, i: let(upto(i), lambda end: F.struct((end - F.length(m)).alias("start"), no.alias("kind_no"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("m"), F.length(F.get(f["g"], i)).alias("n")))
            return F.filter(F.transform(f["m"], place), lambda x: x["n"] >= least)

        return _running(F.transform(f["m"], lambda m, i: F.length(m) + F.length(F.get(f["s"], i))), each)

    return F.when(F.rlike(text, p), let(found, spans))


def _plain(spans: Column) -> Column:
    bare = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.coalesce(bare, F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """The base spans of a text (no null), ordered by start, then kind."""
    return F.sort_array(F.concat(_plain(_matches(text, ASSIGN, "assign", 1, ASSIGNED_LEAST)), _plain(_matches(text, ACCESS, "access")), _plain(_matches(text, HEX, "hex"))))


def _kl(share: Column, rate: float) -> Column:
    """Relative entropy in nats of a coin of ``share`` to one of ``rate``; 0 unless share is larger."""
    up = lambda x, r: F.when(x > 0, x * F.log(x / r)).otherwise(F.lit(0.0))
    return F.when(share > rate, up(share, rate) + up(1 - share, 1 - rate)).otherwise(F.lit(0.0))


#: Coefficients of a Chebyshev fit of the complementary error function, from the highest power down.
ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def upper_tail(z: Column) -> Column:
    """The chance that a normal variable is over ``z``, to seven digits."""

    def of(x: Column) -> Column:
        t = 1 / (1 + 0.5 * F.abs(x))

        def of_t(t: Column) -> Column:
            poly = F.lit(ERFC[0])
            for c in ERFC[1:]:
                poly = poly * t + c
            tail = 0.5 * t * F.exp(poly - x * x)
            return F.when(x >= 0, tail).otherwise(1 - tail)

        return let(t, of_t)

    return let(z / F.lit(2.0**0.5), of)


def _pair_moments(n: Column, two: Column, three: Column) -> tuple[Column, Column]:
    """Mean and variance of the number of equal pairs among ``n`` draws, by the chances of two and of three being equal."""
    pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    return pairs * two, pairs * two * (1 - two) + 6 * triples * (three - two * two)


def battery(token: Column) -> Column:
    """Struct of ``encoding``, ``p_chi``, ``p_runs``, ``p_serial`` (against uniform draws) and ``score``: -log10 of the
    bound of the p-value against ordinary writing."""
    core = F.rtrim(token, F.lit("="))
    encoding = F.lit(64)
    for size, pattern, _ in reversed(ENCODINGS):
        encoding = F.when(F.rlike(core, F.lit(f"^({pattern})$")), F.lit(size)).otherwise(encoding)

    def of(t: Column) -> Column:
        k, shown = t["k"], t["core"]
        n = F.length(shown).cast("double")
        alphabet = F.lit(ALPHABET)
        for size, _, own in ENCODINGS:
            alphabet = F.when(k == size, F.lit(own)).otherwise(alphabet)
        value = lambda c: F.instr(alphabet, c) - 1
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        changed = lambda a: F.size(F.filter(a, lambda c, i: (i > 0) & (c != F.coalesce(F.get(a, i - 1), c)))).cast("double")

        def of_values(v: Column) -> Column:
            x = F.transform(v, value).cast("array<double>")
            high = lambda x: F.transform(x, lambda b: b > (k - 1) / 2.0)
            classes = F.transform(v, lambda c: F.when(F.rlike(c, F.lit("[0-9]")), F.lit(0)).when(F.rlike(c, F.lit("[a-z]")), F.lit(1)).when(F.rlike(c, F.lit("[A-Z]")), F.lit(2)).otherwise(F.lit(3)))

            def of_numbers(y: Column) -> Column:
                x, m = y["x"], (k - 1) / 2.0
                counts = F.transform(F.array_distinct(v), lambda c: (F.length(shown) - F.length(F.replace(shown, c, F.lit("")))).cast("double"))
                product = F.transform(x, lambda b, i: (b - m) * (F.coalesce(F.get(x, i - 1), m) - m))
                return F.struct(total(F.transform(counts, lambda c: c * (c - 1) / 2)).alias("pairs"), changed(y["high"]).alias("turns"), changed(y["classes"]).alias("changes"), total(product).alias("product"))

            def of_sums(s: Column) -> Column:
                p = 1.0 / k
                mean, variance = _pair_moments(n, p, p * p)
                third = n * (n - 1) / 2 * p * (1 - p) * (1 - 2 * p) + n * (n - 1) * (n - 2) * p * p * (1 - p)
                skew = third / F.pow(variance, F.lit(1.5))
                z = (s["pairs"] - 0.5 - mean) / F.sqrt(variance)
                z_chi = let(1 + skew * z / 2, lambda b: (F.signum(b) * F.cbrt(F.abs(b)) - 1) * 6 / skew + skew / 6)
                two_sided = lambda z: F.least(F.lit(1.0), 2 * upper_tail(z))
                z_runs = (F.abs(s["turns"] - (n - 1) / 2) - 0.5) / (F.sqrt(n - 1) / 2)
                z_serial = F.abs(s["product"]) / ((k * k - 1) / 12.0 * F.sqrt(n - 1))
                ordinary = {both: _pair_moments(n, F.lit(q), F.lit(t)) for both, (q, t) in EQUAL.items()}
                few = {both: (s["pairs"] + 0.5 - m) / F.sqrt(v) for both, (m, v) in ordinary.items()}
                z_few = F.least(F.lit(0.0), F.when(k > 36, few[True]).otherwise(few[False]))
                nats = F.greatest(F.when(k == 16, n * _kl(F.lit(1.0), HEX_SHARE)).otherwise(F.lit(0.0)), (n - 1) * _kl(s["changes"] / (n - 1), CHANGE_SHARE), z_few * z_few / 2)
                return F.struct(k.alias("encoding"), upper_tail(z_chi).alias("p_chi"), two_sided(z_runs).alias("p_runs"), two_sided(z_serial).alias("p_serial"), F.greatest(F.lit(0.0), (nats - F.log(F.lit(3.0))) / F.log(F.lit(10.0))).alias("score"))

            # arrays that a lambda looks into are bound first: an expression there would be built again for each element
            numbers = let(x, lambda x: let(F.struct(x.alias("x"), high(x).alias("high"), classes.alias("classes")), of_numbers))
            return let(numbers, of_sums)

        return let(F.split(shown, "(?!$)"), of_values)

    def cased(t: Column) -> Column:
        return F.struct(F.when(t["k"] <= 36, F.lower(t["core"])).otherwise(t["core"]).alias("core"), t["k"].alias("k"))

    return let(let(F.struct(core.alias("core"), encoding.alias("k")), cased), of)


def looks_random(b: Column) -> Column:
    return 3 * F.least(b["p_chi"], b["p_runs"], b["p_serial"]) >= REJECT


def _free(runs: Column, base: Column) -> Column:
    """The runs that touch no base span, in one sweep over both in the order of their starts: a run is touched if one
    that starts before it ends after its start, or the next to start after it starts before its end."""
    shape = lambda s, m: F.struct(s["start"].alias("start"), s["end"].alias("end"), m.alias("m"))
    both = F.sort_array(F.concat(F.transform(base, lambda b: shape(b, F.lit(None).cast("string"))), F.transform(runs, lambda r: shape(r, r["m"]))))
    never = F.lit(1 - (1 << 31))

    def swept(x: Column) -> Column:
        of_base = lambda y, value: F.when(y["m"].isNull(), value).otherwise(never)
        ends, starts = F.transform(x, lambda y: of_base(y, y["end"])), F.reverse(F.transform(x, lambda y: of_base(y, -y["start"])))
        clear = lambda before, after: F.filter(x, lambda y, i: y["m"].isNotNull() & (before(i) <= y["start"]) & (-after(F.size(x) - 1 - i) >= y["end"]))
        return _running(ends, lambda before: _running(starts, lambda after: clear(before, after), never, _larger), never, _larger)

    return F.when(F.size(base) == 0, F.transform(runs, lambda r: shape(r, r["m"]))).otherwise(let(both, swept))


def tested(docs: DataFrame, text: str, base: str, candidates: str) -> DataFrame:
    """``docs`` with the base spans of the text, and with all runs that touch none, each with its score: 0 if it isn't uniform.

    Each step is a column of its own: an expression nested as deep as all of them takes the analyzer too many rounds.
    """
    runs = fresh("runs", [*docs.columns, base, candidates])
    t = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn(base, base_spans(t)).withColumn(runs, _matches(t, RANDOM, "random"))
    free = let(F.struct(F.col(runs).alias("runs"), F.col(base).alias("base")), lambda x: F.when(x["runs"].isNotNull(), _free(x["runs"], x["base"])))
    score = lambda m: let(battery(m), lambda b: F.when(looks_random(b), b["score"]).otherwise(F.lit(0.0)))
    scored = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), score(r["m"]).alias("score")))
    return docs.withColumn(runs, free).withColumn(candidates, F.coalesce(scored, F.array().cast("array<struct<start:int,end:int,score:double>>"))).drop(runs)


def _length_class(start: Column, end: Column) -> Column:
    n = end - start
    out = F.lit(0)
    for i, least in enumerate(LENGTHS[1:], 1):
        out = F.when(n >= least, F.lit(i)).otherwise(out)
    return out


def thresholds(scanned: DataFrame, candidates: str = "candidates") -> list[float]:
    """Per length class, the least score that Benjamini-Hochberg accepts of all runs tested (infinite if none).

    Works on counts per class and bin: at most ``len(LENGTHS) * (BINS + 1)`` rows reach the driver.
    """
    c = F.col("c")
    binned = scanned.select(F.explode(candidates).alias("c")).select(_length_class(c["start"], c["end"]).alias("k"), F.least(F.floor(c["score"] / BIN), F.lit(BINS)).alias("bin"))
    counts: dict[int, dict[int, int]] = {}
    for r in binned.groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r["k"], {})[r["bin"]] = r["n"]
    out = []
    for k in range(len(LENGTHS)):
        bins = counts.get(k, {})
        m, above, best = sum(bins.values()), 0, float("inf")
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b * BIN) <= ALPHA * above / m:
                best = b * BIN
        out.append(best)
    return out


def scan(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: ``keys``, ``base`` (spans of the patterns) and ``found`` (these and the battery's)."""
    base, candidates = fresh("base", keys), fresh("candidates", keys)
    scored = tested(docs.select(*keys, F.col(text).alias(fresh("text", keys))), fresh("text", keys), base, candidates)
    scanned = staged(scored.select(*keys, base, candidates), "secret-spans")
    return scanned.select(*keys, F.col(base).alias("base"), all_spans(F.col(base), F.col(candidates), thresholds(scanned, candidates)).alias("found"))


def all_spans(base: Column, candidates: Column, limits: list[float]) -> Column:
    limit = F.array(*[F.lit(x) for x in limits])
    true = F.filter(candidates, lambda c: c["score"] >= F.get(limit, _length_class(c["start"], c["end"])))
    added = F.transform(true, lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind_no"), F.lit("random").alias("kind"), c["end"].alias("end")))
    return F.sort_array(F.concat(base, added))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with the union of the spans (by start) replaced by a mark for each stretch."""
    block = lambda at: F.floor(at / F.lit(CHARACTERS)).cast("int")

    def between(blocks: Column, start: Column, end: Column) -> Column:
        first, last = block(start), block(end)
        head = F.substring(F.get(blocks, first), start % CHARACTERS + 1, F.least(end - start, F.lit(CHARACTERS)))
        tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end % CHARACTERS)
        apart = F.concat(head, F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), tail)
        return F.when(end <= start, F.lit("")).when(first == last, head).otherwise(apart)

    def of(x: Column) -> Column:
        spans, blocks = x["spans"], x["blocks"]

        def joined(upto) -> Column:
            end = lambda i: F.when(i == 0, F.lit(0)).otherwise(upto(i - 1))
            pieces = F.transform(spans, lambda s, i: let(end(i), lambda e: F.when((i == 0) | (s["start"] > e), F.concat(between(blocks, e, s["start"]), F.lit(mark))).otherwise(F.lit(""))))
            rest = let(end(F.size(spans)), lambda e: between(blocks, e, x["n"]))
            return F.concat(F.array_join(pieces, ""), rest)

        return _running(F.transform(spans, lambda s: s["end"]), joined, F.lit(0), _larger)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHARACTERS}}}"), F.lit(0))
    return let(F.struct(spans.alias("spans"), blocks.alias("blocks"), F.length(text).alias("n")), of)


def cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets redacted and ``n_chars``, where there is one, set to the new length.

    The thresholds come from a first pass over the texts, which stages only scores; the second pass finds the spans
    again beside the text, so that texts are never shuffled.
    """
    base, candidates = fresh("base", docs.columns), fresh("candidates", docs.columns)
    limits = thresholds(staged(tested(docs.select(text), text, base, candidates).select(candidates), "secret-scores"), candidates)
    found = tested(docs, text, base, candidates).withColumn(base, all_spans(F.col(base), F.col(candidates), limits))
    clean = F.when((F.size(base) == 0) | F.col(text).isNull(), F.col(text)).otherwise(redacted(F.col(text), F.col(base)))
    sized = {"n_chars": F.coalesce(F.length(text).cast("bigint"), F.lit(0).cast("bigint"))} if "n_chars" in docs.columns else {}
    return found.withColumn(text, clean).withColumns(sized).select(*[f"`{c}`" for c in docs.columns])
