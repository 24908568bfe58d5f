"""Interval, transcript and window operators against plain Python on random segments, and hand-made cases."""

import random
import time

import pytest
from pyspark.sql import functions as F

from talkweave.operators import chunks, intervals, quality, transcript, windows

SEG = "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double, audio_sec double"
TEXT = "call_id bigint, ordinal bigint, speaker string, start double, end double, raw_text string, asr_status string"


def random_calls(seed, calls=30, most=14):
    rng = random.Random(seed)
    for call in range(calls):
        t = 0.0
        for i in range(rng.randint(1, most)):
            t = max(0.0, t + rng.choice([-0.5, -0.25, 0.0, 0.125, 0.25, 0.5, 1.5]))
            yield call, i, rng.choice("AB"), t, t + rng.choice([0.0625, 0.25, 0.375, 0.5, 1.0, 3.0]), rng.choice(["hi", "Hi ", "go on", ""]), rng.choice(["ok", "ok", "ok", "error", "skipped_short"])
            t += rng.choice([0.0, 0.5, 1.0])


def by_call(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def naive_entries(rows, audio, least, gap, reach, pad):
    """The passes one after the other on a plain list: [start, end, speaker, sources]."""
    items = [[max(0.0, s), min(audio, e), who, {i}] for s, e, i, who in sorted((r[3], r[4], r[1], r[2]) for r in rows)]
    items = [x for x in items if x[1] > x[0]]
    groups = []
    for x in items:
        if groups and groups[-1][2] == x[2] and x[0] - groups[-1][1] <= gap:
            groups[-1][1] = max(groups[-1][1], x[1])
            groups[-1][3] |= x[3]
        else:
            groups.append(x)
    i = 0
    while i < len(groups):
        x = groups[i]
        near = []
        if len(groups) > 1 and x[1] - x[0] < least:
            if i > 0:
                near.append((max(0.0, x[0] - groups[i - 1][1]), 0, i - 1))
            if i + 1 < len(groups):
                near.append((max(0.0, groups[i + 1][0] - x[1]), 1, i + 1))
        near = [n for n in near if n[0] <= reach]
        if not near:
            i += 1
            continue
        target = groups[min(near)[2]]
        target[0], target[1] = (min(target[0], x[0]), target[1]) if min(near)[1] else (target[0], max(target[1], x[1]))
        target[3] |= x[3]
        del groups[i]
    groups = [[max(0.0, a - pad), min(audio, b + pad), who, src] for a, b, who, src in groups]
    groups = sorted((g for g in groups if g[1] > g[0]), key=lambda g: g[:2])
    n_conflicts = 0
    for x, y in zip(groups, groups[1:]):
        if not x[1] > y[0]:
            continue
        n_conflicts += 1
        dx, dy = max(0.0, x[1] - x[0]), max(0.0, y[1] - y[0])
        if x[2] == y[2] or (min(dx, dy) <= max(0.08, least / 2) and dx > dy):
            x[1], x[3] = max(x[1], y[1]), x[3] | y[3]
            y[0] = y[1]
        elif min(dx, dy) <= max(0.08, least / 2):
            y[0], y[3] = min(x[0], y[0]), x[3] | y[3]
            x[1] = x[0]
        else:
            m = (x[1] + y[0]) / 2
            x[1], y[0] = max(x[0], m), min(y[1], m)
    return sorted((a, b, who, sorted(src)) for a, b, who, src in groups if b > a), n_conflicts


def test_all_passes_equal_the_naive_ones(spark):
    data = list(random_calls(1, 60))
    audio = {c: max(r[4] for r in rs) - 0.25 for c, rs in by_call(data).items()}
    df = spark.createDataFrame([(c, i, i, who, s, e, audio[c]) for c, i, who, s, e, _, _ in data], SEG)
    entries = intervals.resolved_entries(df).cache()
    got = by_call((r.call_id, (r.start, r.end, r.speaker, list(r.source_indices))) for r in intervals.groups(entries).collect())
    report = {r.call_id: r for r in intervals.report(df, entries).collect()}
    for call, rows in by_call(data).items():
        expect, conflicts = naive_entries(rows, audio[call], 0.45, 0.3, 0.22, 0.06)
        found = sorted(x for _, x in got.get(call, []))
        assert [x[2:] for x in found] == [tuple(x[2:]) for x in expect], call
        assert [x[:2] for x in found] == [pytest.approx(x[:2]) for x in expect], call
        assert report[call].overlap_conflicts_count == conflicts and report[call].output_segments == len(expect) and report[call].input_segments == len(rows)


def test_absorb_tie_goes_left(spark):
    df = spark.createDataFrame([(1, 0, 0, "A", 0.0, 1.0, 9.0), (1, 1, 1, "B", 1.125, 1.375, 9.0), (1, 2, 2, "C", 1.5, 3.0, 9.0)], SEG)
    rows = intervals.absorbed(intervals.merged(intervals.clipped(df), 300), 450, 220).orderBy("start").collect()
    assert [(r.speaker, r.start, r.end, r.source_indices, r.n_absorbed) for r in rows] == [("A", 0.0, 1.375, [0, 1], 1), ("C", 1.5, 3.0, [2], 0)]


def test_empty_and_clipped_away(spark):
    none = spark.createDataFrame([], SEG)
    assert intervals.resolved_entries(none).count() == 0 and intervals.report(none, intervals.resolved_entries(none)).count() == 0
    gone = spark.createDataFrame([(1, 0, 0, "A", 5.0, 6.0, 4.0)], SEG)
    r = intervals.report(gone, intervals.resolved_entries(gone)).first()
    assert (r.input_segments, r.output_segments, r.short_segment_ratio_after, r.merge_gap_ms) == (1, 0, 0.0, None)


def naive_clean(rows, near=0.28):
    kept = []
    for r in sorted((r for r in rows if r[6] != "skipped_short" and r[5].strip()), key=lambda r: (r[3], r[4], r[1])):
        if kept:
            k = kept[-1]
            same = k[2] == r[2] and k[5].strip().lower() == r[5].strip().lower()
            shared = max(0.0, min(k[4], r[4]) - max(k[3], r[3]))
            close = abs(k[3] - r[3]) <= near and abs(k[4] - r[4]) <= near
            if same and (close or shared / max(1e-6, min(k[4] - k[3], r[4] - r[3])) >= 0.8):
                if r[4] - r[3] > k[4] - k[3]:
                    kept[-1] = r
                continue
        kept.append(r)
    times = [[r[3], r[4]] for r in kept]
    n = 0
    for x, y in zip(times, times[1:]):
        if x[1] > y[0]:
            n += 1
            m = (x[1] + y[0]) / 2
            x[1], y[0] = max(x[0], m), min(y[1], m)
    return [(r[1], s, e) for r, (s, e) in zip(kept, times) if e > s], len(kept), n


def test_cleanup_equals_the_naive_one(spark):
    data = list(random_calls(2, 60))
    df = spark.createDataFrame(data, TEXT)
    got = by_call((r.call_id, (r.ordinal, r.start, r.end)) for r in transcript.cleaned(df).collect())
    report = {r.call_id: r for r in transcript.report(df).collect()}
    for call, rows in by_call(data).items():
        expect, once, conflicts = naive_clean(rows)
        assert sorted(x for _, x in got.get(call, [])) == sorted(expect), call
        r = report[call]
        assert (r.output_segments, r.overlap_conflicts_count, r.input_segments) == (len(expect), conflicts, len(rows))
        assert r.duplicate_segments_removed == len(rows) - r.skipped_short_removed - r.empty_segments_removed - once


def test_longer_duplicate_wins_and_containment_collapses(spark):
    rows = [(1, 0, "A", 0.0, 1.0, "x", "ok"), (1, 1, "A", 0.1, 1.25, "X ", "ok"), (2, 0, "A", 0.0, 10.0, "a", "ok"), (2, 1, "B", 2.0, 3.0, "b", "ok")]
    got = sorted((r.call_id, r.start, r.end) for r in transcript.cleaned(spark.createDataFrame(rows, TEXT)).collect())
    assert got == [(1, 0.1, 1.25), (2, 0.0, 6.0)]


def naive_windows(rows, chars, seconds, gap, switches):
    out = []
    for r in rows:
        if out:
            w = out[-1]
            changed = w["speaker"] != r[2]
            fits = max(0.0, r[3] - w["end"]) <= gap and w["chars"] + len(r[5].strip()) <= chars and max(0.0, r[4] - w["start"]) <= seconds and w["switches"] + changed <= switches
            if fits:
                w["chars"] += len(r[5].strip())
                w["switches"] += changed
                w.update(speaker=r[2], end=r[4])
                w["ordinals"].append(r[1])
                continue
        out.append({"start": r[3], "end": r[4], "chars": len(r[5].strip()), "switches": 0, "speaker": r[2], "ordinals": [r[1]]})
    return out


@pytest.mark.parametrize("limits", [(80, 5.0, 0.5, 1), (400, 25.0, 1.2, 6)])
def test_windows_equal_the_naive_ones(spark, limits):
    data = [(*r[:5], r[5] * 9, r[6]) for r in random_calls(3, 40)]
    df = transcript.positioned(spark.createDataFrame(data, TEXT))
    order = {(r.call_id, r.position): r.ordinal for r in df.collect()}
    got = {}
    for r in windows.built(windows.assigned(df, *limits)).orderBy("call_id", "window_index").collect():
        got.setdefault(r.call_id, []).append(([order[r.call_id, p] for p in r.segment_positions], r.start, r.end, r.chars_count))
    for call, rows in by_call(data).items():
        rows = sorted((r for r in rows if r[5].strip()), key=lambda r: (r[3], r[4], r[1]))
        assert got.get(call, []) == [(w["ordinals"], w["start"], w["end"], w["chars"]) for w in naive_windows(rows, *limits)], call


def test_windows_of_a_known_call(spark):
    rows = [(1, 0, "S00", 0.0, 1.2, "да", "ok"), (1, 1, "S00", 1.3, 2.0, "нет", "ok"), (1, 2, "S01", 2.1, 3.1, "ну", "ok"), (1, 3, "S00", 7.8, 8.6, "вот", "ok")]
    df = transcript.positioned(spark.createDataFrame(rows, TEXT))
    w = windows.built(windows.assigned(df, 140, 12.0, 1.0, 3)).orderBy("window_index").collect()
    assert [(x.segment_positions, x.speakers) for x in w] == [([0, 1, 2], ["S00", "S01"]), ([3], ["S00"])]
    r = windows.report(df, windows.built(windows.assigned(df, 140, 12.0, 1.0, 3)), 140, 12.0, 1.0, 3).first()
    assert (r.windows_total, r.segments_total, r.segments_covered, r.median_window_duration_sec) == (2, 4, 4, pytest.approx(1.95))


def test_quality_and_chunks(spark):
    c = spark.createDataFrame([(1, 0, 0, "S 0!", 0.0, 10.0, "a.wav"), (1, 1, 1, " ", 9.0, 11.0, "")], "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double, chunk_path string")
    t = spark.createDataFrame([(1, 0, 0, "H", "ok"), (1, 1, 0, "Hi", "ok")], "call_id bigint, ordinal bigint, idx bigint, raw_text string, status string")
    f = spark.createDataFrame([(1, 0, "a.wav", "H", "", "hi")], "call_id bigint, ordinal bigint, chunk_path string, raw_text string, anonymized_text string, enhanced_text string")
    rows = {r.chunk_index: r for r in quality.chunk_rows(c, t, f).collect()}
    a, b = rows[0], rows[1]
    assert (a.raw_text, a.chars_per_sec, a.low_confidence_marker, a.overlap_marker, a.cleaned_out, a.suspicious_substitution_flag) == ("Hi", 0.2, True, True, False, True)
    assert (b.asr_status, b.cleaned_out, b.dominant_language) == ("missing", True, "unknown")
    s = quality.summary(quality.chunk_rows(c, t, f)).first()
    assert (s.chunks_total, s.low_confidence_chunk_ratio, s.cleaned_out_chunks) == (2, 1.0, 1)
    assert [r[0] for r in c.select(chunks.chunk_path(c.idx, c.speaker)).orderBy("idx").collect()] == ["chunk_0000_S_0_.wav", "chunk_0001_speaker.wav"]


def test_labels_lose_white_space_of_all_kinds(spark):
    from pyspark.sql import functions as F

    from talkweave.operators import chunks

    df = spark.createDataFrame([("\tSPK",), ("\u00a0a b\n",), ("  ",), ("",)], "s string")
    assert [r.x for r in df.select(chunks.safe_label(F.col("s")).alias("x")).collect()] == ["SPK", "a_b", "speaker", "speaker"]


def test_calls_without_a_duration_end_with_their_last_segment(spark):
    from talkweave.operators import intervals

    rows = spark.createDataFrame([(1, 0.0, 2.0), (2, 0.0, 3.0)], "call_id bigint, start double, end double")
    found = intervals.with_duration(rows, spark.createDataFrame([(1, 9.0)], "call_id bigint, audio_sec double"))
    assert {r.call_id: r.audio_sec for r in found.collect()} == {1: 9.0, 2: 3.0}


def test_long_calls_in_linear_time(spark):
    """One call of many overlapping and short segments: four times the length takes no more than some six times as long."""

    def seconds(n):
        x = F.col("id")
        segs = spark.range(n).select(F.lit(1).cast("bigint").alias("call_id"), x.alias("ordinal"), x.alias("idx"), F.concat(F.lit("S"), x % 3).alias("speaker"), (x * 0.2).alias("start"), (x * 0.2 + F.when(x % 5 == 0, 0.1).otherwise(0.6)).alias("end"))
        began = time.time()
        found = intervals.groups(intervals.resolved_entries(intervals.with_duration(segs), absorb_short_gap_ms=500)).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("source_indices")).alias("sources")).first()
        assert found.sources >= n * 0.99 and found.n > n / 10
        return time.time() - began

    seconds(1000)
    short, long = seconds(50_000), seconds(200_000)
    assert long < 6 * short + 10


def test_a_chain_of_takers_is_flattened_once():
    rope = (None, [0])
    for i in range(1, 200_000):
        rope = ((None, [i]), rope)
    assert intervals._flat(rope) == list(range(199_999, -1, -1))
