"""DuckDB SQL for the registered queries, written apart from the Spark plans. Left out: what needs a per-call list as state."""

from __future__ import annotations

from .queries import GIVEN

#: Segments derived from the conversations; see ``sources.fixtures``. Times are s and e, in seconds.
SEG = """
b AS (SELECT conv_id AS call_id, turn AS ordinal, coalesce(text, '') AS raw_text, length(coalesce(text, '')) AS n FROM conversations),
d AS (SELECT *, CASE WHEN (call_id * 5 + ordinal) % 29 = 0 THEN 1000 * n WHEN (call_id * 3 + ordinal * 5) % 7 = 0 THEN 100 + n % 300 ELSE 200 + 60 * least(n, 200) END AS dur,
             ((call_id * 7 + ordinal * 13) % 17 - 3) * 150 AS gap, CASE WHEN (call_id + ordinal) % 4 < 2 THEN 'SPEAKER_00' ELSE 'SPEAKER_01' END AS speaker FROM b),
t AS (SELECT *, CAST(greatest(0, coalesce(sum(dur + gap) OVER (PARTITION BY call_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + gap) AS BIGINT) AS st FROM d),
u AS (SELECT call_id, ordinal, speaker, raw_text, st, st + dur AS en FROM t
      UNION ALL SELECT call_id, ordinal + 1000000, speaker, raw_text, st + 100, st + dur + 150 FROM t WHERE (call_id + ordinal) % 11 = 0),
v AS (SELECT *, CASE WHEN en - st < 250 THEN 'skipped_short' WHEN (call_id + ordinal) % 23 = 0 THEN 'error' ELSE 'ok' END AS asr_status FROM u),
seg AS (SELECT call_id, ordinal, speaker, st::DOUBLE / 1000 AS s, en::DOUBLE / 1000 AS e, CASE WHEN asr_status = 'error' THEN '' ELSE raw_text END AS raw_text, asr_status FROM v)"""

CHUNK = SEG + """,
ix AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) - 1 AS idx FROM seg),
chunk AS (SELECT *, printf('chunk_%04d_%s.wav', idx, speaker) AS chunk_path FROM ix),
said0 AS (SELECT call_id, idx, ordinal, raw_text, asr_status AS status FROM chunk WHERE idx % 13 <> 5),
said AS (SELECT call_id, idx, CASE WHEN idx % 7 = 3 THEN raw_text || ' again' ELSE raw_text END AS raw_text, status FROM said0)"""

EVENT = """
ms AS (SELECT user_id AS call_id, event_id AS ordinal, event_type AS speaker, epoch_ms(ts) AS ms FROM events),
st AS (SELECT *, (ms - min(ms) OVER (PARTITION BY call_id)) // 100000 AS st FROM ms),
seg AS (SELECT call_id, ordinal, ordinal AS idx, speaker, st::DOUBLE / 1000 AS s, (st + 50 + (ordinal * 37) % 2000)::DOUBLE / 1000 AS e FROM st),
aud AS (SELECT *, max(s) OVER (PARTITION BY call_id) AS audio, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS seq FROM seg),
clip AS (SELECT * FROM (SELECT call_id, ordinal, idx, seq, speaker, audio, greatest(0.0, s) AS s, least(audio, e) AS e FROM aud) WHERE e > s)"""

_MERGED = """,
m1 AS (SELECT *, sum(ch) OVER (PARTITION BY call_id ORDER BY seq) AS run FROM (SELECT *, CASE WHEN speaker <> lag(speaker) OVER (PARTITION BY call_id ORDER BY seq) THEN 1 ELSE 0 END AS ch FROM clip)),
m2 AS (SELECT *, max(e) OVER (PARTITION BY call_id, run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m1),
m3 AS (SELECT *, sum(CASE WHEN reach IS NULL OR s - reach > 0.3 THEN 1 ELSE 0 END) OVER (PARTITION BY call_id ORDER BY seq) AS grp FROM m2),
mg AS (SELECT call_id, min(seq) AS seq, arg_min(speaker, seq) AS speaker, min(s) AS s, max(e) AS e, max(audio) AS audio, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS source_indices, count(*) - 1 AS n_merged FROM m3 GROUP BY call_id, grp),
pad AS (SELECT * FROM (SELECT call_id, seq, speaker, greatest(0.0, s - 0.06) AS s, least(audio, e + 0.06) AS e, source_indices FROM mg) WHERE e > s)"""

#: The longest of repeats, row by row within a call: the state is the last kept row.
KEPT = SEG + r""",
f AS (SELECT *, lower(regexp_replace(trim(raw_text), '\s+', ' ', 'g')) AS norm, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS rn FROM seg WHERE asr_status <> 'skipped_short' AND trim(raw_text) <> ''),
k AS (SELECT call_id, rn, 1 AS grp, s, e, ordinal, speaker, norm FROM f WHERE rn = 1
      UNION ALL
      SELECT f.call_id, f.rn, k.grp + CASE WHEN x.dup THEN 0 ELSE 1 END, CASE WHEN x.stay THEN k.s ELSE f.s END, CASE WHEN x.stay THEN k.e ELSE f.e END, CASE WHEN x.stay THEN k.ordinal ELSE f.ordinal END, f.speaker, f.norm
      FROM k JOIN f ON f.call_id = k.call_id AND f.rn = k.rn + 1,
      LATERAL (SELECT dup, dup AND NOT (greatest(0, f.e - f.s) > greatest(0, k.e - k.s)) AS stay FROM (SELECT f.speaker = k.speaker AND f.norm = k.norm
        AND ((abs(k.s - f.s) <= 0.28 AND abs(k.e - f.e) <= 0.28) OR greatest(0, least(k.e, f.e) - greatest(k.s, f.s)) / greatest(1e-6, least(greatest(0, k.e - k.s), greatest(0, f.e - f.s))) >= 0.8) AS dup)) x),
kept AS (SELECT * FROM k QUALIFY rn = max(rn) OVER (PARTITION BY call_id, grp))"""


def middle(rel: str) -> str:
    """Overlaps of neighbours cut in the middle, over a relation with call_id, s, e, ordinal."""
    return f"""
w AS (SELECT *, lag(e) OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS pe, lead(s) OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS ns FROM {rel}),
w2 AS (SELECT *, CASE WHEN pe > s THEN least(e, (pe + s) / 2) ELSE s END AS s2, coalesce(e > ns, false) AS conflict FROM w),
cut AS (SELECT * EXCLUDE (s, e, pe, ns, s2), s2 AS s, CASE WHEN conflict THEN greatest(s2, (e + ns) / 2) ELSE e END AS e FROM w2)"""


#: Lines of documents as segments, eight a window, with what the stand-in model makes of them.
LINES = r"""
la AS (SELECT doc_id AS call_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
lb AS (SELECT call_id, i, regexp_replace(line, '^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g') AS source FROM la),
l0 AS (SELECT call_id, source, row_number() OVER (PARTITION BY call_id ORDER BY i) - 1 AS position FROM lb WHERE source <> ''),
l1 AS (SELECT *, position // 8 AS window_index, regexp_replace(regexp_replace(source, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g'), '[0-9]{8,}', '[ID]', 'g') AS masked,
       regexp_matches(source, '\b\+?\d[\d\s\-()]{6,}\b') OR regexp_matches(source, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') OR regexp_matches(source, '\b\d{8,}\b') AS pii FROM l0),
l2 AS (SELECT *, first_value(length(source)) OVER (PARTITION BY call_id, window_index ORDER BY position) % 13 = 0 AS failed FROM l1),
l3 AS (SELECT *, failed OR contains(source, '#') AS fell_back FROM l2),
l4 AS (SELECT *, CASE WHEN fell_back THEN source ELSE masked END AS output FROM l3),
l5 AS (SELECT *, (length(output) - length(replace(output, '[EMAIL]', ''))) // 7 AS n_email, (length(output) - length(replace(output, '[ID]', ''))) // 4 AS n_id FROM l4)"""

WINDOWS = SEG + """,
p AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) - 1 AS position, trim(raw_text) AS txt FROM seg),
q AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, position) AS rn FROM p WHERE trim(raw_text) <> ''),
z AS (SELECT call_id, rn, 0 AS window_index, s AS first, length(txt) AS chars, 0 AS switches, e AS last_e, speaker FROM q WHERE rn = 1
      UNION ALL
      SELECT q.call_id, q.rn, z.window_index + CASE WHEN x.cut THEN 1 ELSE 0 END, CASE WHEN x.cut THEN q.s ELSE z.first END, CASE WHEN x.cut THEN length(q.txt) ELSE z.chars + length(q.txt) END,
             CASE WHEN x.cut THEN 0 ELSE z.switches + x.sw END, q.e, q.speaker
      FROM z JOIN q ON q.call_id = z.call_id AND q.rn = z.rn + 1,
      LATERAL (SELECT sw, greatest(0, q.s - z.last_e) > 1.2 OR z.chars + length(q.txt) > 400 OR greatest(0, q.e - z.first) > 25.0 OR z.switches + sw > 6 AS cut FROM (SELECT CASE WHEN z.speaker <> q.speaker THEN 1 ELSE 0 END AS sw)) x),
wr AS (SELECT q.*, z.window_index FROM q JOIN z USING (call_id, rn)),
wn AS (SELECT call_id, window_index, string_agg(position::VARCHAR, ',' ORDER BY rn) AS segment_positions, min(s) AS s, arg_max(e, rn) AS e, count(*) AS segments_count, sum(length(txt))::BIGINT AS chars_count, string_agg(txt, '|' ORDER BY rn) AS texts FROM wr GROUP BY ALL),
wd AS (SELECT *, greatest(0, e - s) AS dur FROM wn)"""

TEXTS = "given(text_id, text) AS (VALUES " + ", ".join("({}, '{}')".format(i, t.replace("'", "''")) for i, t in enumerate(GIVEN)) + """),
texts AS (SELECT text_id, text FROM given UNION ALL SELECT conv_id * 1000 + turn + 1000, coalesce(text, '') FROM conversations)"""

SEG_RE = """'(?is)<SEG\\s+id=[''"]?(\\d+)[''"]?>(.*?)</SEG>'"""
WORD = "'[A-Za-zА-Яа-яЁёӘәІіҢңҒғҮүҰұҚқӨөҺһ0-9]+'"


def label(token: str) -> str:
    has = lambda c: f"regexp_matches({token}, '[{c}]')"
    return f"CASE WHEN {has('ӘәІіҢңҒғҮүҰұҚқӨөҺһ')} THEN 'kk' WHEN {has('А-Яа-яЁё')} AND {has('A-Za-z')} THEN 'mixed' WHEN {has('А-Яа-яЁё')} THEN 'ru' WHEN {has('A-Za-z')} THEN 'lat' ELSE 'other' END"


#: Labelled white-space tokens of the texts, in order, without ``other``.
TOKENS = TEXTS + f""",
tk AS (SELECT text_id, unnest(string_split_regex(trim(text), '\\s+')) AS tok, generate_subscripts(string_split_regex(trim(text), '\\s+'), 1) AS i FROM texts),
lb AS (SELECT text_id, i, {label('tok')} AS label FROM tk),
ok AS (SELECT *, lag(label) OVER (PARTITION BY text_id ORDER BY i) AS before FROM lb WHERE label <> 'other')"""

WORDS = TEXTS + f""",
wd AS (SELECT text_id, text_id // 10 AS group_id, unnest(regexp_extract_all(text, {WORD})) AS tok, generate_subscripts(regexp_extract_all(text, {WORD}), 1) AS i FROM texts),
lb AS (SELECT *, {label('tok')} AS label FROM wd)"""

LIGHT = "(SELECT CASE WHEN regexp_matches(c, '^\\p{L}') THEN upper(c[1]) || c[2:] ELSE c END FROM (SELECT regexp_replace(trim(X), '\\s+', ' ', 'g') AS c))"
R = lambda c, name=None: f"round({c}, 6) AS {name or c}"
TIMES = "round(s, 6) AS start_sec, round(e, 6) AS end_sec"

QUALITY = CHUNK + r""",
asm AS (SELECT c.call_id, c.idx, c.speaker, c.s, c.e, c.ordinal, c.chunk_path, coalesce(x.raw_text, '') AS raw_text, coalesce(x.status, 'error') AS asr_status FROM chunk c LEFT JOIN said x USING (call_id, idx)),
f AS (SELECT *, lower(regexp_replace(trim(raw_text), '\s+', ' ', 'g')) AS norm, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS rn FROM asm WHERE asr_status <> 'skipped_short' AND trim(raw_text) <> ''),
""" + KEPT[KEPT.index("k AS (") :] + """,
kept2 AS (SELECT kept.call_id, kept.s, kept.e, kept.ordinal, a.raw_text, a.chunk_path FROM kept JOIN asm a USING (call_id, ordinal)),""" + middle("kept2") + """,
fnl AS (SELECT call_id, chunk_path, raw_text, """ + LIGHT.replace("X", "raw_text") + """ AS enhanced FROM cut WHERE e > s),
tk AS (SELECT call_id, idx, unnest(string_split_regex(trim(raw_text), '\\s+')) AS tok, generate_subscripts(string_split_regex(trim(raw_text), '\\s+'), 1) AS i FROM said),
lb AS (SELECT call_id, idx, i, """ + label("tok") + """ AS label FROM tk),
lk AS (SELECT *, lag(label) OVER (PARTITION BY call_id, idx ORDER BY i) AS before FROM lb WHERE label <> 'other'),
lang AS (SELECT call_id, idx, bool_or(coalesce(label <> before, false)) AS sw, count(*) FILTER (label = 'ru') AS ru, count(*) FILTER (label = 'kk') AS kk, count(*) FILTER (label = 'lat') AS lat, count(*) FILTER (label = 'mixed') AS mx FROM lk GROUP BY ALL),
ov AS (SELECT call_id, idx, coalesce(lag(e) OVER o > s, false) OR coalesce(e > lead(s) OVER o, false) AS overlap_marker FROM chunk WINDOW o AS (PARTITION BY call_id ORDER BY s, e, idx)),
cq AS (SELECT c.call_id, c.idx AS chunk_index, c.speaker, c.s, c.e, greatest(0, c.e - c.s) AS dur, c.chunk_path, coalesce(x.status, 'missing') AS asr_status, trim(coalesce(x.raw_text, '')) AS raw_text, ov.overlap_marker,
         coalesce(l.sw, false) AS code_switch_presence, CASE WHEN coalesce(greatest(ru, kk, lat, mx), 0) = 0 THEN 'unknown' WHEN ru = greatest(ru, kk, lat, mx) THEN 'ru' WHEN kk = greatest(ru, kk, lat, mx) THEN 'kk' WHEN lat = greatest(ru, kk, lat, mx) THEN 'lat' ELSE 'mixed' END AS dominant_language,
         fnl.raw_text IS NULL AS cleaned_out, fnl.raw_text IS NOT NULL AND trim(fnl.raw_text) <> trim(fnl.enhanced) AS enhancement_changed_text,
         fnl.raw_text IS NOT NULL AND lower(regexp_extract_all(fnl.raw_text, """ + WORD + """)::VARCHAR) <> lower(regexp_extract_all(fnl.enhanced, """ + WORD + """)::VARCHAR) AS suspicious_substitution_flag
       FROM chunk c LEFT JOIN said x USING (call_id, idx) JOIN ov USING (call_id, idx) LEFT JOIN lang l USING (call_id, idx) LEFT JOIN fnl ON fnl.call_id = c.call_id AND fnl.chunk_path = c.chunk_path),
qr AS (SELECT *, length(raw_text) AS raw_text_length, length(raw_text) / greatest(1e-6, dur) AS cps FROM cq),
qq AS (SELECT *, asr_status <> 'ok' OR raw_text = '' OR cps < 1.5 OR cps > 28.0 AS low_confidence_marker FROM qr)"""

#: Short segments joined to a neighbour, row by row: the state is the last entry passed (t..) and what the next one takes up (c..).
_ABSORBED = """,
a0 AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY seq) AS rn, lead(s) OVER (PARTITION BY call_id ORDER BY seq) AS ns, count(*) OVER (PARTITION BY call_id) AS n,
         string_split(source_indices, ',')::BIGINT[] AS src, CASE WHEN n_merged > 0 THEN ['same_speaker_gap'] ELSE []::VARCHAR[] END AS rs FROM mg),
ab AS (SELECT call_id, 0::BIGINT AS rn, n, false AS has, 0.0::DOUBLE AS ts, 0.0::DOUBLE AS te, ''::VARCHAR AS tsp, 0::BIGINT AS tseq, []::BIGINT[] AS tsrc, []::VARCHAR[] AS trs, 0::BIGINT AS tab,
         NULL::DOUBLE AS cs, []::BIGINT[] AS csrc, 0::BIGINT AS cab, false AS em, 0.0::DOUBLE AS es, 0.0::DOUBLE AS ee, ''::VARCHAR AS esp, 0::BIGINT AS eseq, []::BIGINT[] AS esrc, []::VARCHAR[] AS ers, 0::BIGINT AS eab FROM a0 WHERE rn = 1
       UNION ALL
       SELECT call_id, rn, n, has OR w = 'P', CASE w WHEN 'P' THEN s ELSE ts END, CASE w WHEN 'P' THEN e WHEN 'L' THEN greatest(te, e) ELSE te END, CASE w WHEN 'P' THEN sp ELSE tsp END, CASE w WHEN 'P' THEN seq ELSE tseq END,
         CASE w WHEN 'P' THEN src WHEN 'L' THEN tsrc || src ELSE tsrc END, CASE w WHEN 'P' THEN rs WHEN 'L' THEN trs || ['absorbed_short'] ELSE trs END, CASE w WHEN 'P' THEN nab WHEN 'L' THEN tab + nab + 1 ELSE tab END,
         CASE w WHEN 'R' THEN least(ns, s) END, CASE w WHEN 'R' THEN src ELSE []::BIGINT[] END, CASE w WHEN 'R' THEN nab + 1 ELSE 0 END, has AND w = 'P', ts, te, tsp, tseq, tsrc, trs, tab
       FROM (SELECT *, CASE WHEN e - s < 0.45 AND (has OR ns IS NOT NULL) AND r <= 0.22 AND r < l THEN 'R' WHEN e - s < 0.45 AND (has OR ns IS NOT NULL) AND l <= 0.22 THEN 'L' ELSE 'P' END AS w FROM (
         SELECT *, CASE WHEN has THEN greatest(0, s - te) ELSE 'infinity'::DOUBLE END AS l, CASE WHEN ns IS NOT NULL THEN greatest(0, ns - e) ELSE 'infinity'::DOUBLE END AS r FROM (
           SELECT ab.* EXCLUDE (rn), a0.rn, a0.ns, a0.seq, a0.speaker AS sp, a0.e, coalesce(ab.cs, a0.s) AS s, a0.src || ab.csrc AS src, CASE WHEN ab.cs IS NULL THEN a0.rs ELSE a0.rs || ['absorbed_short'] END AS rs, ab.cab AS nab
           FROM ab JOIN a0 ON a0.call_id = ab.call_id AND a0.rn = ab.rn + 1)))),
abs AS (SELECT call_id, eseq AS seq, esp AS speaker, es AS s, ee AS e, esrc AS src, ers AS rs, eab AS nab FROM ab WHERE em UNION ALL SELECT call_id, tseq, tsp, ts, te, tsrc, trs, tab FROM ab WHERE rn = n)"""

#: Then padded, and overlaps settled with their lineage and counts.
_SETTLED = """,
o AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, seq) AS rn, count(*) OVER (PARTITION BY call_id) AS n FROM (
  SELECT abs.* EXCLUDE (s, e), greatest(0.0, s - 0.06) AS s, least(x.audio, e + 0.06) AS e FROM abs JOIN (SELECT call_id, max(audio) AS audio FROM mg GROUP BY call_id) x USING (call_id)) WHERE e > s),
g AS (SELECT call_id, rn, n, speaker AS sp, s AS ls, e AS le, seq, src, rs, ''::VARCHAR AS dsp, 0.0::DOUBLE AS ds, 0.0::DOUBLE AS de, 0::BIGINT AS dseq, []::BIGINT[] AS dsrc, []::VARCHAR[] AS drs, 'N' AS w FROM o WHERE rn = 1
      UNION ALL
      SELECT call_id, rn, n, osp, CASE w WHEN 'N' THEN os WHEN 'S' THEN oe WHEN 'A' THEN least(os, ls) WHEN 'B' THEN oe ELSE least(oe, (le + os) / 2) END, oe, oseq, CASE w WHEN 'A' THEN osrc || src ELSE osrc END, CASE w WHEN 'A' THEN ors || ['reassigned_short_overlap'] ELSE ors END,
        sp, ls, CASE w WHEN 'N' THEN le WHEN 'A' THEN ls WHEN 'M' THEN greatest(ls, (le + os) / 2) ELSE greatest(le, oe) END, seq, CASE WHEN w IN ('S', 'B') THEN src || osrc ELSE src END,
        CASE w WHEN 'S' THEN rs || ['same_speaker_overlap'] WHEN 'B' THEN rs || ['reassigned_short_overlap'] ELSE rs END, w
      FROM (SELECT *, CASE WHEN le <= os THEN 'N' WHEN sp = osp THEN 'S' WHEN least(greatest(0, le - ls), greatest(0, oe - os)) > 0.225 THEN 'M' WHEN greatest(0, le - ls) <= greatest(0, oe - os) THEN 'A' ELSE 'B' END AS w FROM (
        SELECT g.* EXCLUDE (rn, w), o.rn, o.speaker AS osp, o.s AS os, o.e AS oe, o.seq AS oseq, o.src AS osrc, o.rs AS ors FROM g JOIN o ON o.call_id = g.call_id AND o.rn = g.rn + 1))),
fin AS (SELECT call_id, dsp AS speaker, ds AS s, de AS e, dseq AS seq, dsrc AS src, drs AS rs FROM g WHERE rn > 1 UNION ALL SELECT call_id, sp, ls, le, seq, src, rs FROM g WHERE rn = n)"""

MERGED = EVENT + _MERGED
ABSORBED = MERGED + _ABSORBED
SETTLED = ABSORBED + _SETTLED

SOURCES = "array_to_string(list_sort(list_distinct(src)), ',') AS source_indices, array_to_string(list_sort(list_distinct(rs)), ',') AS merge_reasons"

#: The same passes over the conversations' segments, whose audio ends with the last of them.
CALLS = (
    QUALITY
    + """,
aud AS (SELECT *, max(e) OVER (PARTITION BY call_id) AS audio, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS seq FROM ix),
clip AS (SELECT * FROM (SELECT call_id, ordinal, idx, seq, speaker, audio, greatest(0.0, s) AS s, least(audio, e) AS e FROM aud) WHERE e > s)"""
    + _MERGED + _ABSORBED + _SETTLED
    + """,
fe AS (SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) AS pos, """ + LIGHT.replace("X", "raw_text") + """ AS en FROM cut WHERE e > s),
ft AS (SELECT call_id, pos, unnest(regexp_extract_all(en, """ + WORD + """)) AS tok, generate_subscripts(regexp_extract_all(en, """ + WORD + """), 1) AS i FROM fe),
fl AS (SELECT *, lag(label) OVER (PARTITION BY call_id ORDER BY pos, i) AS before FROM (SELECT *, """ + label("tok") + """ AS label FROM ft) WHERE label <> 'other'),
sw AS (SELECT call_id, CASE WHEN count(*) < 2 THEN 0 ELSE count(*) FILTER (before <> label) / (count(*) - 1) END AS ratio FROM fl GROUP BY call_id),
pn AS (SELECT call_id, (length(j) - length(regexp_replace(j, '[.,!?;:()\\[\\]{}"''-]', '', 'g'))) / length(j) AS density FROM (SELECT call_id, string_agg(en, ' ' ORDER BY pos) AS j FROM fe GROUP BY call_id))"""
)

ORACLES = {
    "call_metrics": f"""WITH RECURSIVE {CALLS} SELECT c.call_id, c.n AS asr_chunks_total, c.n AS total_segments_before_postprocess, coalesce(f.n, 0) AS total_segments_after_postprocess, 0::BIGINT AS semantic_drift_flags_total, q.low AS low_confidence_chunk_ratio,
  round(coalesce(sw.ratio, 0), 6) AS language_switching_ratio, round(coalesce(pn.density, 0), 6) AS punctuation_density_after_enhancement, 0::BIGINT AS llm_calls_total
FROM (SELECT call_id, count(*) AS n FROM chunk GROUP BY call_id) c LEFT JOIN (SELECT call_id, count(*) AS n FROM fin WHERE e > s GROUP BY call_id) f USING (call_id) LEFT JOIN (SELECT call_id, round(count(*) FILTER (low_confidence_marker) / count(*), 6) AS low FROM qq GROUP BY call_id) q USING (call_id)
LEFT JOIN sw USING (call_id) LEFT JOIN pn USING (call_id)""",
    "absorb_short": f"WITH RECURSIVE {ABSORBED} SELECT call_id, speaker, {TIMES}, {SOURCES}, nab AS n_absorbed FROM abs",
    "merge_groups": f"WITH RECURSIVE {SETTLED} SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY s, e, seq) - 1 AS output_index, speaker, {TIMES}, round(e - s, 6) AS duration_sec, {SOURCES} FROM fin WHERE e > s",
    "postprocess_report": f"""WITH RECURSIVE {SETTLED}, i AS (SELECT call_id, count(*) AS input_segments FROM seg GROUP BY call_id), c AS (SELECT call_id, count(*) AS nv, count(*) FILTER (e - s < 0.45) AS sb FROM clip GROUP BY call_id),
m AS (SELECT call_id, sum(n_merged)::BIGINT AS nm FROM mg GROUP BY call_id), a AS (SELECT call_id, sum(nab)::BIGINT AS na FROM abs GROUP BY call_id),
k AS (SELECT call_id, count(*) FILTER (w <> 'N') AS nc, count(*) FILTER (w IN ('A', 'B')) AS nr, count(*) FILTER (w IN ('S', 'A', 'B')) AS ng FROM g GROUP BY call_id), f AS (SELECT call_id, count(*) AS nf, count(*) FILTER (e - s < 0.45) AS sa FROM fin WHERE e > s GROUP BY call_id)
SELECT call_id, input_segments, coalesce(nf, 0) AS output_segments, coalesce(nm, 0) + coalesce(na, 0) + coalesce(ng, 0) AS merged_segments_count, coalesce(nc, 0) AS overlap_conflicts_count, coalesce(sb, 0) AS short_segments_before, coalesce(sa, 0) AS short_segments_after,
  coalesce(na, 0) AS absorbed_short_segments_count, coalesce(nr, 0) AS reassigned_short_overlap_count, round(coalesce(sb, 0) / greatest(1, coalesce(nv, 0)), 6) AS short_segment_ratio_before, round(coalesce(sa, 0) / greatest(1, coalesce(nf, 0)), 6) AS short_segment_ratio_after,
  CASE WHEN nv > 0 THEN 450::BIGINT END AS min_segment_duration_ms, CASE WHEN nv > 0 THEN 300::BIGINT END AS merge_gap_ms, CASE WHEN nv > 0 THEN 60::BIGINT END AS padding_ms, CASE WHEN nv > 0 THEN 220::BIGINT END AS absorb_short_gap_ms
FROM i LEFT JOIN c USING (call_id) LEFT JOIN m USING (call_id) LEFT JOIN a USING (call_id) LEFT JOIN k USING (call_id) LEFT JOIN f USING (call_id)""",
    "valid_segments": f"WITH {SEG} SELECT call_id, ordinal, speaker, {TIMES} FROM seg WHERE e > s",
    "reindex_segments": f"WITH {EVENT} SELECT call_id, ordinal, seq - 1 AS idx, speaker, {TIMES} FROM aud",
    "clip_segments": f"WITH {EVENT} SELECT call_id, ordinal, speaker, {TIMES} FROM clip",
    "merge_same_speaker": f"WITH {MERGED} SELECT call_id, speaker, {TIMES}, source_indices, CASE WHEN n_merged > 0 THEN 'same_speaker_gap' ELSE '' END AS merge_reasons, n_merged FROM mg",
    "pad_segments": f"WITH {MERGED} SELECT call_id, speaker, {TIMES}, source_indices FROM pad",
    "resolve_overlaps": f"""WITH RECURSIVE {MERGED},
o AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, seq) AS rn, count(*) OVER (PARTITION BY call_id) AS n FROM pad),
g AS (SELECT call_id, rn, n, speaker AS sp, s AS ls, e AS le, NULL::VARCHAR AS dsp, NULL::DOUBLE AS ds, NULL::DOUBLE AS de FROM o WHERE rn = 1
      UNION ALL
      SELECT o.call_id, o.rn, o.n, o.speaker,
        CASE WHEN g.le <= o.s THEN o.s WHEN o.speaker = g.sp THEN o.e WHEN x.tiny AND x.dl <= x.dr THEN least(o.s, g.ls) WHEN x.tiny THEN o.e ELSE least(o.e, (g.le + o.s) / 2) END, o.e, g.sp, g.ls,
        CASE WHEN g.le <= o.s THEN g.le WHEN o.speaker = g.sp THEN greatest(g.le, o.e) WHEN x.tiny AND x.dl <= x.dr THEN g.ls WHEN x.tiny THEN greatest(g.le, o.e) ELSE greatest(g.ls, (g.le + o.s) / 2) END
      FROM g JOIN o ON o.call_id = g.call_id AND o.rn = g.rn + 1,
      LATERAL (SELECT dl, dr, least(dl, dr) <= 0.225 AS tiny FROM (SELECT greatest(0, g.le - g.ls) AS dl, greatest(0, o.e - o.s) AS dr)) x),
r AS (SELECT call_id, dsp AS speaker, ds AS s, de AS e FROM g WHERE rn > 1 UNION ALL SELECT call_id, sp, ls, le FROM g WHERE rn = n)
SELECT call_id, speaker, {TIMES} FROM r WHERE e > s""",
    "chunk_manifest": f"""WITH {CHUNK} SELECT call_id, idx, start_frame, end_frame, chunk_path FROM (SELECT *, greatest(0, trunc(s * 16000)::BIGINT) AS start_frame, least(trunc(max(e) OVER (PARTITION BY call_id) * 16000)::BIGINT, trunc(e * 16000)::BIGINT) AS end_frame FROM chunk) WHERE end_frame > start_frame""",
    "asr_eligibility": f"WITH {CHUNK} SELECT call_id, idx, {R('greatest(0.0, e - s)', 'duration_sec')}, CASE WHEN greatest(0.0, e - s) < 0.25 THEN 'skipped_short' ELSE 'ok' END AS status FROM chunk",
    "asr_batches": f"WITH {CHUNK} SELECT call_id, batch_id, count(*) AS n_chunks, {R('sum(dur)', 'audio_sec')} FROM (SELECT call_id, dur, (row_number() OVER (PARTITION BY call_id ORDER BY ordinal) - 1) // 4 AS batch_id FROM (SELECT *, greatest(0.0, e - s) AS dur FROM chunk) WHERE dur >= 0.25) GROUP BY ALL",
    "asr_report": f"""WITH {CHUNK}, x AS (SELECT c.call_id, greatest(0.0, c.e - c.s) AS dur, greatest(0.0, c.e - c.s) >= 0.25 AS el, coalesce(t.status = 'ok', false) AS ok, length(trim(t.raw_text)) AS n FROM chunk c LEFT JOIN said t USING (call_id, idx)),
g AS (SELECT call_id, count(*) AS total_chunks, count(*) FILTER (el) AS eligible_chunks, count(*) FILTER (el AND ok) AS processed_chunks, count(*) FILTER (NOT el) AS skipped_short_chunks, count(*) FILTER (el AND NOT ok) AS failed_chunks,
  sum(dur) AS a, coalesce(sum(dur) FILTER (el), 0) AS l, coalesce(sum(n) FILTER (el AND ok), 0)::BIGINT AS ch, count(*) FILTER (el AND ok AND n = 0) AS em FROM x GROUP BY call_id)
SELECT call_id, total_chunks, eligible_chunks, processed_chunks, skipped_short_chunks, failed_chunks, 2::BIGINT AS asr_batch_size, 4::BIGINT AS asr_orchestration_batch_size, round(CASE WHEN eligible_chunks > 0 AND a > 0 THEN l / a ELSE 0 END, 6) AS asr_audio_coverage_ratio,
  round(CASE WHEN eligible_chunks > 0 THEN ch / greatest(1e-6, l) ELSE 0 END, 6) AS chars_per_second_of_audio, round(em / greatest(1, processed_chunks), 6) AS empty_asr_output_ratio, (eligible_chunks + 3) // 4 AS orchestration_batches_total,
  array_to_string(list_transform(range(0, (eligible_chunks + 3) // 4), lambda i: least(4, eligible_chunks - i * 4)), ',') AS actual_orchestration_batch_sizes FROM g""",
    "nearest_rank_percentile": f"WITH {SEG}, g AS (SELECT call_id, list_sort(list(e - s)) AS d FROM seg GROUP BY call_id) SELECT call_id, round(d[1 + round_even((len(d) - 1) * 0.5, 0)::INT], 6) AS p50, round(d[1 + round_even((len(d) - 1) * 0.9, 0)::INT], 6) AS p90 FROM g",
    "merge_transcript": f"WITH {CHUNK} SELECT c.call_id, c.idx, c.speaker, {TIMES}, coalesce(x.raw_text, '') AS raw_text, coalesce(x.status, 'error') AS asr_status, chunk_path FROM chunk c LEFT JOIN said x USING (call_id, idx)",
    "chunk_quality": f"WITH RECURSIVE {QUALITY} SELECT call_id, chunk_index, speaker, {TIMES}, round(dur, 6) AS duration_sec, chunk_path, asr_status, raw_text, raw_text_length, round(cps, 6) AS chars_per_sec, code_switch_presence, dominant_language, low_confidence_marker, overlap_marker, cleaned_out, enhancement_changed_text, suspicious_substitution_flag FROM qq",
    "cleaned_out_chunks": f"WITH RECURSIVE {QUALITY} SELECT call_id, chunk_index AS idx, chunk_path FROM qq WHERE cleaned_out",
    "quality_summary": f"""WITH RECURSIVE {QUALITY} SELECT call_id, count(*) AS chunks_total, count(*) FILTER (low_confidence_marker) AS low_confidence_chunks, count(*) FILTER (code_switch_presence) AS code_switch_chunks, count(*) FILTER (overlap_marker) AS overlap_chunks,
  count(*) FILTER (cleaned_out) AS cleaned_out_chunks, count(*) FILTER (enhancement_changed_text) AS enhancement_changed_chunks, count(*) FILTER (suspicious_substitution_flag) AS suspicious_substitution_chunks, round(avg(cps), 6) AS avg_chars_per_sec,
  round(count(*) FILTER (low_confidence_marker) / count(*), 6) AS low_confidence_chunk_ratio, round(count(*) FILTER (code_switch_presence) / count(*), 6) AS code_switch_chunk_ratio, 1.5::DOUBLE AS low_confidence_min_cps, 28.0::DOUBLE AS low_confidence_max_cps FROM qq GROUP BY call_id""",
    "chunk_overlap": f"WITH {EVENT} SELECT call_id, seq - 1 AS idx, coalesce(lag(e) OVER o > s, false) OR coalesce(e > lead(s) OVER o, false) AS overlap_marker FROM aud WINDOW o AS (PARTITION BY call_id ORDER BY s, e, seq)",
    "cleanup_filter": f"WITH {SEG} SELECT call_id, ordinal, CASE WHEN asr_status = 'skipped_short' THEN 'skipped_short' WHEN trim(raw_text) = '' AND greatest(0, e - s) < 0.35 THEN 'short_empty' WHEN trim(raw_text) = '' THEN 'empty' ELSE 'kept' END AS fate, lower(regexp_replace(trim(raw_text), '\\s+', ' ', 'g')) AS norm_text FROM seg",
    "dedup_segments": f"WITH RECURSIVE {KEPT} SELECT call_id, ordinal, speaker, {TIMES} FROM kept",
    "clip_overlaps": f"WITH {EVENT}, {middle('seg')} SELECT call_id, ordinal, {TIMES}, conflict FROM cut",
    "cleanup_report": f"""WITH RECURSIVE {KEPT}, {middle('kept')}, a AS (SELECT call_id, count(*) AS input_segments, count(*) FILTER (asr_status = 'skipped_short') AS skipped_short_removed, count(*) FILTER (asr_status <> 'skipped_short' AND trim(raw_text) = '') AS empty_segments_removed,
  count(*) FILTER (asr_status <> 'skipped_short' AND trim(raw_text) = '' AND greatest(0, e - s) < 0.35) AS short_empty_segments_removed FROM seg GROUP BY call_id),
c AS (SELECT call_id, count(*) AS once, count(*) FILTER (conflict) AS con, count(*) FILTER (e <= s) AS col FROM cut GROUP BY call_id)
SELECT call_id, input_segments, coalesce(once - col, 0) AS output_segments, skipped_short_removed, empty_segments_removed, short_empty_segments_removed, input_segments - skipped_short_removed - empty_segments_removed - coalesce(once, 0) AS duplicate_segments_removed,
  coalesce(con, 0) AS overlap_conflicts_count, coalesce(col, 0) AS collapsed_segments_removed, 350::BIGINT AS cleanup_min_duration_ms, 280::BIGINT AS cleanup_duplicate_window_ms FROM a LEFT JOIN c USING (call_id)""",
    "semantic_windows": f"""WITH RECURSIVE {WINDOWS}, sp AS (SELECT call_id, window_index, string_agg(speaker, ',' ORDER BY rn) AS speakers FROM (SELECT *, lag(speaker) OVER (PARTITION BY call_id, window_index ORDER BY rn) AS b FROM wr) WHERE b IS NULL OR b <> speaker GROUP BY ALL)
SELECT call_id, window_index::BIGINT AS window_index, segment_positions, {TIMES}, round(dur, 6) AS duration_sec, speakers, segments_count, chars_count, texts FROM wd JOIN sp USING (call_id, window_index)""",
    "semantic_window_report": f"""WITH RECURSIVE {WINDOWS}, g AS (SELECT call_id, count(*) AS windows_total, sum(segments_count)::BIGINT AS sc, avg(segments_count) AS a1, avg(chars_count) AS a2, avg(dur) AS a3, median(dur) AS a4, max(segments_count) AS m FROM wd GROUP BY call_id)
SELECT call_id, count(*) AS segments_total, coalesce(any_value(windows_total), 0) AS windows_total, coalesce(any_value(sc), 0) AS segments_covered, round(coalesce(any_value(a1), 0), 6) AS avg_segments_per_window, round(coalesce(any_value(a2), 0), 6) AS avg_chars_per_window,
  round(coalesce(any_value(a3), 0), 6) AS avg_window_duration_sec, round(coalesce(any_value(a4), 0), 6) AS median_window_duration_sec, coalesce(any_value(m), 0) AS max_segments_per_window, 400::BIGINT AS max_chars, 25.0::DOUBLE AS max_duration_sec, 1.2::DOUBLE AS max_gap_sec, 6::BIGINT AS max_speaker_switches
FROM seg LEFT JOIN g USING (call_id) GROUP BY call_id""",
    "window_segments": f"WITH RECURSIVE {WINDOWS} SELECT call_id, window_index::BIGINT AS window_index, row_number() OVER (PARTITION BY call_id, window_index ORDER BY rn) - 1 AS local_index, position, speaker, raw_text FROM wr",
    "low_confidence_segments": f"WITH {SEG}, x AS (SELECT *, length(trim(raw_text)) / greatest(1e-6, e - s) AS cps FROM seg) SELECT call_id, ordinal, round(cps, 6) AS chars_per_sec, asr_status <> 'ok' OR trim(raw_text) = '' OR cps < 1.5 OR cps > 28.0 AS low_confidence FROM x",
    "language_switching_ratio": f"WITH {WORDS}, k AS (SELECT *, lag(label) OVER (PARTITION BY group_id ORDER BY text_id, i) AS b FROM lb WHERE label <> 'other'), g AS (SELECT group_id, count(*) AS n, count(*) FILTER (b <> label) AS sw FROM k GROUP BY group_id) SELECT DISTINCT t.text_id // 10 AS group_id, round(CASE WHEN coalesce(n, 0) < 2 THEN 0 ELSE sw / (n - 1) END, 6) AS ratio FROM texts t LEFT JOIN g ON g.group_id = t.text_id // 10",
    "punctuation_density": f"WITH {TEXTS}, g AS (SELECT text_id // 10 AS group_id, coalesce(string_agg(text, ' ' ORDER BY text_id) FILTER (text <> ''), '') AS j FROM texts GROUP BY ALL) SELECT group_id, round(CASE WHEN j = '' THEN 0 ELSE (length(j) - length(regexp_replace(j, '[.,!?;:()\\[\\]{{}}\"''-]', '', 'g'))) / length(j) END, 6) AS density FROM g",
    "normalize_words": f"WITH {TEXTS} SELECT text_id, array_to_string(list_transform(regexp_extract_all(text, {WORD}), lambda x: lower(x)), ',') AS words FROM texts",
    "token_language": f"WITH {WORDS} SELECT label, count(*) AS n, count(DISTINCT tok) AS n_distinct FROM lb GROUP BY label",
    "code_switch": f"WITH {TOKENS} SELECT t.text_id, coalesce(bool_or(label <> before), false) AS switched FROM texts t LEFT JOIN ok USING (text_id) GROUP BY t.text_id",
    "dominant_language": f"""WITH {TOKENS}, g AS (SELECT t.text_id, count(*) FILTER (label = 'ru') AS ru, count(*) FILTER (label = 'kk') AS kk, count(*) FILTER (label = 'lat') AS lat, count(*) FILTER (label = 'mixed') AS mx FROM texts t LEFT JOIN ok USING (text_id) GROUP BY t.text_id)
SELECT text_id, CASE greatest(ru, kk, lat, mx) WHEN 0 THEN 'unknown' WHEN ru THEN 'ru' WHEN kk THEN 'kk' WHEN lat THEN 'lat' ELSE 'mixed' END AS language FROM g""",
    "word_drift": f"WITH {TEXTS}, x AS (SELECT text_id, text, CASE WHEN text_id % 3 = 0 THEN text || ' extra' ELSE lower(text) END AS o FROM texts) SELECT text_id, list_transform(regexp_extract_all(text, {WORD}), lambda x: lower(x)) <> list_transform(regexp_extract_all(o, {WORD}), lambda x: lower(x)) AS drift FROM x",
    "placeholder_counts": f"WITH {TEXTS}, p(entity, mark) AS (VALUES ('NAME', '[ИМЯ]'), ('PHONE', '[ТЕЛЕФОН]'), ('ID', '[ID]'), ('ADDRESS', '[АДРЕС]'), ('EMAIL', '[EMAIL]')), x AS (SELECT text_id, entity, (length(text) - length(replace(text, mark, ''))) // length(mark) AS n FROM texts, p) SELECT text_id, entity, n FROM x WHERE n > 0",
    "pii_candidates": r"SELECT doc_id AS text_id, regexp_matches(coalesce(text, ''), '\b\+?\d[\d\s\-()]{6,}\b') OR regexp_matches(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') OR regexp_matches(coalesce(text, ''), '\b\d{8,}\b') AS candidate FROM documents",
    "seg_payload": f"""WITH {TEXTS}, x AS (SELECT text_id // 10 AS group_id, row_number() OVER (PARTITION BY text_id // 10 ORDER BY text_id) - 1 AS i, replace(replace(trim(replace(text, chr(10), ' ')), '&', '&amp;'), '<', '&lt;') AS c FROM texts)
SELECT group_id, string_agg('<SEG id="' || i || '">' || c || '</SEG>', chr(10) ORDER BY i) AS payload FROM x GROUP BY group_id""",
    "seg_parse": f"""WITH {TEXTS}, x AS (SELECT text_id, list_zip(regexp_extract_all(text, {SEG_RE}, 1), regexp_extract_all(text, {SEG_RE}, 2)) AS z FROM texts),
y AS (SELECT text_id::BIGINT AS text_id, list_filter(z, lambda p: p[1] = '0') AS a, list_filter(z, lambda p: p[1] = '1') AS b FROM x) SELECT text_id, CASE WHEN len(a) > 0 AND len(b) > 0 THEN trim(a[-1][2]) || '|' || trim(b[-1][2]) ELSE '' END AS texts FROM y""",
    "seg_round_trip": f"WITH {TEXTS} SELECT text_id // 10 AS group_id, string_agg(trim(replace(text, chr(10), ' ')), '|' ORDER BY text_id) AS texts FROM texts GROUP BY ALL",
    "anonymize_passthrough": f"WITH {SEG} SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) - 1 AS position, raw_text AS anonymized_text, '' AS enhanced_text FROM seg",
    "wav_round_trip": """WITH v AS (SELECT printf('part-%06d.wav', vec_id // 100) AS name, unnest(embedding)::FLOAT::DOUBLE * 0.5 AS x FROM embeddings), q AS (SELECT name, greatest(-32768, least(32767, round_even(x * 32768, 0))) / 32768 AS x FROM v)
SELECT name, 8000::INT AS sample_rate, count(*) AS frames, count(*) AS frames_read, round(sqrt(sum(x * x) / count(*)), 6) AS rms, round(max(abs(x)), 6) AS peak FROM q GROUP BY name""",
    "model_answers": f"WITH {LINES} SELECT call_id, window_index, position, output, failed, fell_back, NOT failed AS reused FROM l5",
    "model_report": f"""WITH {LINES}, g AS (SELECT call_id, count(DISTINCT window_index) AS w, count(*) AS n, sum(length(source)) AS chars, count(DISTINCT window_index) FILTER (failed) AS windows_failed, count(*) FILTER (fell_back) AS fallback_segments, count(*) FILTER (pii) AS p,
  count(*) FILTER (pii AND (n_email + n_id > 0 OR regexp_matches(output, '\\[(ИМЯ|ТЕЛЕФОН|АДРЕС)\\]'))) AS m, sum(n_email)::BIGINT AS n_email, sum(n_id)::BIGINT AS n_id FROM l5 GROUP BY call_id)
SELECT call_id, w AS windows_total, w AS llm_calls_total, windows_failed, fallback_segments, p AS pii_candidate_segments, m AS masked_candidate_segments, round(m / greatest(1, p), 6) AS anonymization_recall_proxy, round(chars / w, 6) AS avg_chars_per_llm_call, round(n / w, 6) AS avg_segments_per_llm_call, n_email, n_id FROM g""",
    "anonymize_report": f"WITH RECURSIVE {WINDOWS} SELECT call_id, count(*) AS windows_total, 0::BIGINT AS llm_calls_total, 0::BIGINT AS windows_failed, 0::BIGINT AS fallback_segments, 0::BIGINT AS pii_candidate_segments, 0::DOUBLE AS anonymization_recall_proxy FROM wd GROUP BY call_id",
    "drift_guard": f"WITH {TEXTS} SELECT text_id, CASE WHEN text_id % 7 = 0 THEN {LIGHT.replace('X', 'text')} WHEN text_id % 5 = 0 THEN text ELSE text || ' !' END AS enhanced FROM texts",
    "enhance_deterministic": f"WITH {SEG}, x AS (SELECT *, {LIGHT.replace('X', 'raw_text')} AS en FROM seg) SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) - 1 AS position, en AS enhanced_text, en <> raw_text AS changed FROM x",
    "enhancement_report": f"WITH {SEG}, x AS (SELECT *, {LIGHT.replace('X', 'raw_text')} AS en FROM seg) SELECT call_id, count(*) AS deterministic_only_segments, count(*) FILTER (en <> raw_text) AS deterministic_changed_segments, 0::BIGINT AS llm_calls_total FROM x GROUP BY call_id",
    "asr_transcripts": f"WITH {CHUNK} SELECT call_id, idx, CASE WHEN greatest(0.0, e - s) < 0.25 THEN '' ELSE 'heard ' || chunk_path END AS raw_text, CASE WHEN greatest(0.0, e - s) < 0.25 THEN 'skipped_short' ELSE 'ok' END AS status FROM chunk",
    "enhance_guarded": f"""WITH {SEG}, x AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s, e, ordinal) - 1 AS position, {LIGHT.replace("X", "raw_text")} AS en, trim(raw_text) <> '' AS windowed,
  asr_status <> 'ok' OR trim(raw_text) = '' OR length(trim(raw_text)) / greatest(1e-6, e - s) < 1.5 OR length(trim(raw_text)) / greatest(1e-6, e - s) > 28.0 AS low FROM seg)
SELECT call_id, position, CASE WHEN NOT windowed THEN raw_text WHEN low THEN en ELSE raw_text || '.' END AS enhanced_text, false AS drifted, windowed AND low AS skipped, windowed FROM x""",
    "audio_normalize": "SELECT vec_id::VARCHAR AS path, 16000::BIGINT AS sample_rate, 0.125::DOUBLE AS duration_sec, 1::BIGINT AS channels, 'wav' AS format FROM embeddings",
    "vector_levels": "WITH x AS (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)) / len(embedding) + 1e-8) AS rms, list_max(list_transform(embedding, lambda v: abs(v::DOUBLE))) AS peak FROM embeddings) SELECT vec_id, round(rms, 6) AS rms, round(peak, 6) AS peak, round(20 * log10(greatest(rms, 1e-8)), 6) AS rms_dbfs, round(20 * log10(greatest(peak, 1e-8)), 6) AS peak_dbfs FROM x",
}
