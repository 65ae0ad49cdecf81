"""Named queries of the caption engine, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexical, prompts, replies, text as tx
from ..operators import resegment, results, run, segment, timing, track
from ..sources import files, tables

_WORDS = r"""w0 AS (SELECT conv_id AS track_id, turn, unnest(string_split_regex(text, '\s+')) AS word, generate_subscripts(string_split_regex(text, '\s+'), 1) AS i FROM conversations),
w1 AS (SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY turn, i) - 1 AS pos, word FROM w0 WHERE word != ''),
w2 AS (SELECT *, 60 * length(word) AS dur, (pos * 37 + track_id * 11) % 400 + CASE WHEN pos % 17 = 16 THEN 900 ELSE 0 END AS gap FROM w1),
words AS (SELECT track_id, pos, word, CAST(coalesce(sum(dur + gap) OVER (PARTITION BY track_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms, dur FROM w2),
cues AS (SELECT track_id, pos // 4 AS pos, pos // 4 + 1 AS cue_id, min(start_ms) AS start_ms, max(start_ms + dur) AS end_ms, string_agg(word, ' ' ORDER BY pos) AS text FROM words GROUP BY track_id, pos // 4)"""
_TS = "printf('%02d:%02d:%02d,%03d', {0} // 3600000, {0} // 60000 % 60, {0} // 1000 % 60, {0} % 1000)"
_DETECTIONS = "d AS (SELECT l_orderkey AS frame_id, l_returnflag = 'R' AS person, CAST(trunc(l_quantity) AS INT) * 10 * CAST(trunc(l_quantity) AS INT) * 8 AS area FROM lineitem)"
_RESULTS = "r AS (SELECT track_id, cue_id, CASE WHEN pos % 11 = 0 THEN '' ELSE text END AS revised_zh, ((pos * 13 + track_id) % 101) / 100.0 AS confidence FROM cues WHERE pos % 13 != 5)"


def _cue(f):
    return lambda s, d: f(tables.cues(s, d))


def _detections(s, d):
    q = F.col("l_quantity").cast("int")
    return s.read.parquet(f"{d}/lineitem.parquet").select(
        F.col("l_orderkey").alias("frame_id"), F.when(F.col("l_returnflag") == "R", "person").otherwise("car").alias("cls"),
        (F.col("l_linenumber") * 40).alias("x1"), F.lit(10).alias("y1"), (F.col("l_linenumber") * 40 + q * 10).alias("x2"), (10 + q * 8).alias("y2"),
    )


def _results(cues):
    return cues.where("pos % 13 != 5").select("track_id", "cue_id", F.when(F.col("pos") % 11 == 0, "").otherwise(F.col("text")).alias("revised_zh"), (((F.col("pos") * 13 + F.col("track_id")) % 101) / 100.0).alias("confidence"))


def _contexts(c):
    w = track.by_track()
    prev, nxt = F.collect_list("text").over(w.rowsBetween(-3, -1)), F.collect_list("text").over(w.rowsBetween(1, 3))
    return c.select("track_id", "pos", F.array_join(prev, "|").alias("prev_contexts"), F.array_join(nxt, "|").alias("next_contexts"))


def _frame_sessions(c):
    pts = track.frame_targets(c).withColumn("t_sec", F.col("t_ms") / 1000)
    g = track.sessions(pts.select("track_id", "t_sec"), "track_id", "t_sec", 1.0)
    return g.groupBy("track_id", "session").agg(F.min("t_sec").alias("first_sec"), F.max("t_sec").alias("last_sec"), F.count("*").alias("n"))


def _word_gaps(w):
    return w.select("track_id", "pos", (F.lead("start_ms").over(track.by_track()) - F.col("end_ms")).alias("gap_ms"))


def _anchored(c):
    pos = F.col("pos")
    return c.withColumn("has_anchor", pos % 4 == 2).withColumn("anchor_start_ratio", (pos % 30) / 100.0).withColumn("anchor_end_ratio", 1 - (pos % 20) / 100.0)


def _policies(c):
    order = F.when(F.col("slot") == "start", 0).when(F.col("slot") == "mid", 1).otherwise(2)
    frames = track.frame_targets(c).where((F.col("cue_id") + order) % 5 != 0).select("track_id", "cue_id", "slot")
    parts = [timing.image_policy(c, frames, p).withColumn("policy", F.lit(p)) for p in ("none", "mid", "three", "auto")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _merged(c):
    found = _results(c).join(_anchored(c).select("track_id", "cue_id", (F.col("pos") % 3 == 1).alias("join_with_prev"), "has_anchor", "anchor_start_ratio", "anchor_end_ratio"), ["track_id", "cue_id"])
    return results.merge_results(c, found, results.Joins(min_confidence=0.5))


def _responses(c):
    items = track.serial_windows(c, 6, 2).join(c.select("track_id", "pos", "cue_id", "text"), ["track_id", "pos"])
    once = items.where("pos % 5 != 0").select("track_id", "win", "cue_id", F.col("pos").alias("item_pos"), F.col("text").alias("revised_zh"))
    again = items.where("pos % 3 = 0").select("track_id", "win", "cue_id", (F.col("pos") + 1000).alias("item_pos"), F.concat(F.lit("again "), "text").alias("revised_zh"))
    return timing.last_responses(items, once.unionByName(again))


def _event_replies(s, d):
    n = F.col("event_id") % 3
    said = F.when(n == 0, F.col("props")).when(n == 1, F.concat(F.lit("Sure: "), "props", F.lit(" done"))).otherwise("nothing")
    return s.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("id"), "props", said.alias("payload"))


def _object_field(s, d):
    found = F.try_variant_get(F.try_parse_json(replies.object_text(F.col("payload"))), "$.k", "long")
    return _event_replies(s, d).select("id", found.alias("k"))


def _keyed_items(s, d):
    said = F.concat(F.lit("```json\n{\"cue_"), F.col("id").cast("string"), F.lit("\": \""), F.md5(F.col("props").cast("binary")), F.lit("\"}\n```"))
    got = replies.reply_items(_event_replies(s, d).select("id", said.alias("payload")))
    return got.select("id", F.inline("items")).select("id", "cue_id", "revised_zh", "confidence")


def _in(x, *lists):
    return f"{x} IN ({', '.join(repr(w) if chr(39) not in w else chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39) for ws in lists for w in ws)})"


def _ends(x, ends):
    return f"regexp_matches({x}, '(?:{'|'.join(ends)})$')"


_L = lexical
_NOUN = f"(NOT {_in('n', _L.CONJUNCTIONS, _L.PREPOSITIONS, _L.AUXILIARIES, _L.NEGATIONS)} AND ({_ends('n', _L.NOUN_ENDS)} OR length(n) >= 4 AND NOT {_in('n', _L.SUBJECTS)}))"
_VERB = f"({_in('n', _L.VERBS, _L.AUXILIARIES)} OR {_ends('n', _L.VERB_ENDS)})"
_SUM = [
    "CASE WHEN gap >= 0.8 THEN -0.9 WHEN gap >= 0.3 THEN -0.35 WHEN gap <= 0.08 THEN 0.25 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.PAUSES, _L.FILLERS)} THEN -1.3 ELSE 0 END",
    f"CASE WHEN {_in('n', _L.PAUSES, _L.FILLERS)} THEN -1.9 ELSE 0 END",
    "CASE WHEN regexp_matches(word, '[.!?]+$') THEN -3.4 WHEN regexp_matches(word, '[,;:]+$') THEN -1.3 ELSE 0 END",
    f"CASE WHEN {_in('n', _L.CONJUNCTIONS)} THEN -1.45 ELSE 0 END",
    f"CASE WHEN {_in('n', _L.PREPOSITIONS)} THEN -1.0 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.DETERMINERS)} THEN CASE WHEN {_NOUN} THEN 5.6 ELSE 4.6 END ELSE 0 END",
    f"CASE WHEN {_in('p', _L.SUBJECTS)} AND {_VERB} THEN 5.0 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.AUXILIARIES)} AND {_VERB} THEN 4.5 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.NEGATIONS)} AND {_VERB} THEN 4.2 ELSE 0 END",
    f"CASE WHEN p = 'to' AND {_VERB} THEN 4.0 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.PREPOSITIONS)} AND {_NOUN} THEN 4.2 ELSE 0 END",
    f"CASE WHEN {_ends('p', _L.ADJECTIVE_ENDS)} AND {_NOUN} THEN 3.4 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.CONJUNCTIONS)} AND n != '' AND NOT regexp_matches(word, '[.!?]+$') THEN 2.7 ELSE 0 END",
    f"CASE WHEN {_in('p', _L.VERBS)} AND {_in('n', _L.PARTICLES)} THEN 4.2 ELSE 0 END",
    r"CASE WHEN regexp_matches(word, '^\p{Lu}') AND regexp_matches(nw, '^\p{Lu}') THEN 2.8 ELSE 0 END",
]
_BARE = r"lower(regexp_replace({0}, '^[^\p{{L}}\p{{M}}\p{{N}}_'']+|[^\p{{L}}\p{{M}}\p{{N}}_'']+$', '', 'g'))"
_BORDER = f"""b0 AS (SELECT track_id, pos, word, start_ms / 1000.0::DOUBLE AS s, (start_ms + dur) / 1000.0::DOUBLE AS e FROM words),
b1 AS (SELECT *, lead(word) OVER v AS nw, lead(s) OVER v AS ns, coalesce(lag(e) OVER v, 0) AS bf FROM b0 WINDOW v AS (PARTITION BY track_id ORDER BY pos)),
b2 AS (SELECT *, {_BARE.format("word")} AS p, {_BARE.format("nw")} AS n, ns - e AS gap FROM b1),
b AS (SELECT track_id, pos, word, s, e, ns, bf, CAST(CASE WHEN nw IS NULL THEN CASE WHEN regexp_matches(word, '[.!?]+$') THEN -1.0 ELSE 0.2 END ELSE {" + ".join(_SUM)} END AS DOUBLE) AS border FROM b2)"""
_CLEAN = "t"
for _a, _b in _L.TIDY:
    _CLEAN = "regexp_replace({}, '{}', '{}', 'g')".format(_CLEAN, _a.replace("'", "''"), _b.replace("'", "''").replace("$1", "\\1"))
_CANDIDATES = f"""c0 AS (SELECT x.track_id, x.pos AS i, y.pos AS j, x.s, x.bf, y.e, y.ns, y.border, (SELECT string_agg(z.word, ' ' ORDER BY z.pos) FROM b z WHERE z.track_id = x.track_id AND z.pos BETWEEN x.pos AND y.pos) AS t
FROM b x JOIN b y ON x.track_id = y.track_id AND y.pos BETWEEN x.pos AND x.pos + 41 AND y.e - x.s > 0 AND y.e - x.s <= 7),
c1 AS (SELECT * EXCLUDE t, {_CLEAN} AS text, e - s AS raw, least(7.0, e - s + greatest(0, s - bf) + greatest(0, coalesce(ns, e + 5.0::DOUBLE / 6) - e) + 0.18::DOUBLE) AS shown FROM c0),
c2 AS (SELECT *, length(text) AS chars, greatest(raw, length(text) / 20.0::DOUBLE) AS need FROM c1 WHERE length(text) <= 42 AND length(text) / 20.0::DOUBLE <= shown + 1e-6),
c3 AS (SELECT *, CASE WHEN greatest(need, 5.0::DOUBLE / 6) > shown + 1e-6 THEN need ELSE greatest(need, 5.0::DOUBLE / 6) END AS planned FROM c2)"""


def _candidates(s, d):
    c = segment.candidates(tables.words(s, d))
    return c.select("track_id", "i", "j", "text", "chars", F.bround("planned", 3).alias("planned"), F.bround(F.col("cost") + 0.00003, 3).alias("cost"))


def _finished(s, d):
    return segment.dp_segments(tables.words(s, d))


def _segment_report(s, d):
    words, segs = tables.words(s, d), _finished(s, d)
    ms = segs.select("*", (F.col("idx") - 1).cast("long").alias("pos"), F.bround(F.col("start") * 1000).cast("long").alias("start_ms"), F.bround(F.col("end") * 1000).cast("long").alias("end_ms"))
    return segment.reports(words, timing.broken_rules(ms, keep=tuple(c for c in segs.columns if c != "track_id")))


def _listed(s, d):
    q = F.col("l_quantity").cast("int")
    rows = s.read.parquet(f"{d}/lineitem.parquet").select(
        F.col("l_orderkey").alias("frame_id"), F.col("l_linenumber").alias("det"), F.when(F.col("l_returnflag") == "R", "person").otherwise("car").alias("cls"), (F.col("l_quantity") / 100).alias("conf"),
        F.lit(0).alias("x1"), F.lit(10).alias("y1"), (q * 10).alias("x2"), (10 + q * 8).alias("y2"),
    )
    line = lambda x: F.concat(x["cls"], F.lit(" "), F.format_string("%.2f", x["conf"]), F.lit(" "), F.format_string("%.4f", x["area_ratio"]))
    return track.detection_list(rows, 854 * 480).select("frame_id", F.array_join(F.transform("detections", line), "; ").alias("detections"))


def _serial(c):
    return run.serial_run(c, _results(c).where("revised_zh != ''").select("track_id", "cue_id", "revised_zh"), how=run.Serial(6, 2))


def _history(c):
    h = run.history_lookahead(c, _results(c), 6, 2)
    text = lambda x: F.array_join(F.transform(x, lambda e: e.cast("string")), ",")
    return h.select("track_id", "win", text("history").alias("history"), text("lookahead").alias("lookahead"))


def _images(c):
    order = F.when(F.col("slot") == "start", 0).when(F.col("slot") == "mid", 1).otherwise(2)
    return run.window_images(c, track.frame_targets(c).where((F.col("cue_id") + order) % 5 != 0), 6, 2)


def _shifted(c):
    return run.source_of(c, c.where("pos % 3 != 0").select("track_id", (F.col("pos") + 1).alias("pos"), (F.col("cue_id") + 2).alias("cue_id"), "text"))


def _neighbours(c):
    w = track.by_track()
    near = {f"{k}_{n}": f(n).over(w) for k, f in (("prev", F.lag), ("next", F.lead)) for n in ("cue_id", "start_ms", "end_ms", "text")}
    return c.withColumns(near)


def _cue_prompts(c):
    c = _neighbours(c)
    line = lambda label, k: prompts.context_line(label, *(F.col(k + n) for n in ("cue_id", "start_ms", "end_ms", "text")))
    context = F.concat_ws("\n", line("prev", "prev_"), line("current", ""), line("next", "next_"))
    text = prompts.cue_prompt(F.col("cue_id"), F.col("start_ms"), F.col("end_ms"), F.col("text"), F.lit(""), context, F.lit("mid"))
    return c.select("track_id", "cue_id", context.alias("context"), F.length(text).alias("n"))


def _refine_prompts(c):
    c = _neighbours(c)
    line = lambda label, k: prompts.refine_line(label, *(F.col(k + n) for n in ("cue_id", "start_ms", "end_ms", "text", "text")))
    return c.select("track_id", "cue_id", prompts.refine_prompt(F.col("cue_id"), line("prev", "prev_"), line("current", ""), line("next", "next_")).alias("prompt"))


def _window_prompts(c):
    w = track.serial_windows(c, 6, 2).join(c, ["track_id", "pos"])
    line = prompts.window_line(F.col("cue_id"), F.col("start_ms"), F.col("end_ms"), F.col("text"), F.lit(""))
    g = w.groupBy("track_id", "win").agg(F.sort_array(F.collect_list(F.struct("pos", "cue_id", line.alias("line")))).alias("x"))
    of = lambda f: F.transform("x", lambda e: e[f])
    none = F.array().cast("array<string>")
    return g.select("track_id", "win", prompts.window_prompt(none, of("line"), none, none, of("cue_id")).alias("prompt"))


def _aligned(s, d):
    w = tables.words(s, d)
    one = F.struct("word", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"))
    docs = w.groupBy("track_id", (F.col("pos") % 7).alias("seg")).agg(F.collect_list(one).alias("words")).groupBy("track_id").agg(F.collect_list(F.struct("words")).alias("segments"))
    return files.aligned_words(docs.select("track_id", F.to_json(F.struct(F.lit("en").alias("language"), "segments")).alias("doc")))


def _event_lines(s, d):
    said = F.to_json(F.struct(F.lit("text").alias("type"), F.struct(F.lit("text").alias("type"), F.concat(F.lit("[{\"cue_id\": "), F.col("id").cast("string"), F.lit(", \"zh\": \""), F.md5(F.col("props").cast("binary")), F.lit("\"}]")).alias("text")).alias("part")))
    rows = _event_replies(s, d).select("id", F.concat(F.lit("{\"type\": \"step\"}\n"), said, F.lit("\nnoise")).alias("payload"))
    return replies.reply_items(rows, events=True).select("id", F.inline("items")).select("id", "cue_id", "revised_zh")


def _points(c):
    pts = track.frame_targets(c).select("track_id", (F.col("t_ms") / 1000).alias("t_sec"))
    return track.frame_indices(track.sessions(pts, "track_id", "t_sec", 1.0), 10.0, 500)


def _classes(s, d):
    w = tables.words(s, d).select("track_id", "pos", lexical.bare(F.col("word")).alias("n"))
    return w.select("track_id", "pos", "n", lexical.verb_like(F.col("n")).alias("verb"), lexical.adjective_like(F.col("n")).alias("adjective"), lexical.noun_like(F.col("n")).alias("noun"))


def _defaults(c):
    r = _results(c).withColumn("earlier", F.concat(F.lit("was "), F.col("cue_id").cast("string"))).withColumn("join_with_prev", F.when(F.col("cue_id") % 2 == 0, True)).withColumn("confidence", F.when(F.col("cue_id") % 3 != 0, F.col("confidence")))
    return track.result_defaults(r)


def _padded_text(c):
    return F.concat(F.lit("  ( "), c, F.lit(" ) ,  it 's \u2014 so  ."))


_SPAN = f"'[' || {_TS.format('{0}start_ms')} || ' --> ' || {_TS.format('{0}end_ms')} || ']'"
_CLIP = "CASE WHEN length({0}) > 220 THEN rtrim(substr({0}, 1, 217)) || '...' ELSE {0} END"


def _span(k=""):
    return _SPAN.replace("{0}", k)


def _refine_sql(label, k):
    t = _CLIP.format(f"{k}text")
    return f"CASE WHEN {k}cue_id IS NULL THEN '- {label}: <none>' ELSE '- {label} cue ' || {k}cue_id || ' ' || {_span(k)} || chr(10) || '  EN: ' || {t} || chr(10) || '  ZH: ' || {t} END"


def _context_sql(label, k):
    return f"CASE WHEN {k}cue_id IS NOT NULL THEN '- {label} cue ' || {k}cue_id || ' ' || {_span(k)} || ': ' || {k}text END"


_NEAR = "nb AS (SELECT *, " + ", ".join(f"{f}({n}) OVER v AS {k}_{n}" for k, f in (("prev", "lag"), ("next", "lead")) for n in ("cue_id", "start_ms", "end_ms", "text")) + " FROM cues WINDOW v AS (PARTITION BY track_id ORDER BY pos))"
_WINDOWS = "i AS (SELECT *, unnest(range(greatest(0, CAST(floor((pos - 6) / 4.0) AS BIGINT) + 1), pos // 4 + 1)) AS win FROM cues)"
_HAVE = "hv AS (SELECT track_id, cue_id, revised_zh FROM r WHERE revised_zh != '')"
_RAN = f"{_WINDOWS}, {_HAVE}, nw AS (SELECT track_id, win, bool_or(revised_zh IS NULL) AS runs FROM i LEFT JOIN hv USING (track_id, cue_id) GROUP BY track_id, win), st AS (SELECT track_id, cue_id, any_value(text) AS text, bool_or(runs) AS ok FROM i JOIN nw USING (track_id, win) GROUP BY track_id, cue_id)"
_POINTS = "p AS (SELECT *, CASE WHEN end_ms - start_ms < 400 THEN 30 ELSE 100 END AS pad FROM cues), q AS (SELECT *, least(end_ms, start_ms + pad) AS t0, greatest(start_ms, end_ms - pad) AS t2, (start_ms + end_ms) / 2 AS m FROM p), t AS (SELECT track_id, cue_id, slot, CAST(CASE WHEN t0 > t2 OR slot = 'mid' THEN m WHEN slot = 'start' THEN t0 ELSE t2 END AS DOUBLE) / 1000 AS t_sec FROM q CROSS JOIN (VALUES ('start'), ('mid'), ('end')) s(slot))"
_SESSIONS = f"{_POINTS}, x AS (SELECT *, CASE WHEN t_sec - lag(t_sec) OVER (PARTITION BY track_id ORDER BY t_sec) > 1.0::DOUBLE THEN 1 ELSE 0 END AS new FROM t), y AS (SELECT *, CAST(sum(new) OVER (PARTITION BY track_id ORDER BY t_sec RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session FROM x)"

_QUERIES = {
    "words_from_text": (tables.words, f"WITH {_WORDS} SELECT track_id, pos, word, start_ms, start_ms + dur AS end_ms FROM words"),
    "cues_from_words": (tables.cues, f"WITH {_WORDS} SELECT * FROM cues"),
    "ms_to_ts": (_cue(lambda c: c.select("track_id", "pos", tx.ms_to_ts(F.col("start_ms")).alias("ts"))), f"WITH {_WORDS} SELECT track_id, pos, {_TS.format('start_ms')} AS ts FROM cues"),
    "clip_text": (_cue(lambda c: c.select("track_id", "pos", tx.clip(F.col("text"), 20).alias("clipped"))), f"WITH {_WORDS} SELECT track_id, pos, CASE WHEN length(text) > 20 THEN rtrim(substr(text, 1, 17)) || '...' ELSE text END AS clipped FROM cues"),
    "char_len": (_cue(lambda c: c.select("track_id", "pos", tx.char_len(F.col("text")).alias("n"))), rf"WITH {_WORDS} SELECT track_id, pos, length(regexp_replace(regexp_replace(text, '[\s*]+$', ''), '\s+', '', 'g')) AS n FROM cues"),
    "strip_period": (_cue(lambda c: c.select("track_id", "pos", tx.strip_period(F.col("text")).alias("stripped"))), rf"WITH {_WORDS} SELECT track_id, pos, regexp_replace(trim(text), '[。.]+\s*$', '') AS stripped FROM cues"),
    "neighbour_text": (_cue(track.neighbour_text), f"WITH {_WORDS} SELECT track_id, pos, coalesce(lag(text) OVER w, '') AS prev_text, coalesce(lead(text) OVER w, '') AS next_text FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY pos)"),
    "context_window": (_cue(_contexts), f"WITH {_WORDS} SELECT track_id, pos, coalesce(string_agg(text, '|') OVER (PARTITION BY track_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS prev_contexts, coalesce(string_agg(text, '|') OVER (PARTITION BY track_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), '') AS next_contexts FROM cues"),
    "select_cues": (_cue(lambda c: track.select_cues(c, 5, 60, 20)), f"WITH {_WORDS} SELECT * FROM cues WHERE cue_id BETWEEN 5 AND 60 AND end_ms > start_ms QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY pos) <= 20"),
    "serial_windows": (_cue(lambda c: track.serial_windows(c, 6, 2)), f"WITH {_WORDS} SELECT track_id, unnest(range(greatest(0, CAST(floor((pos - 6) / 4.0) AS BIGINT) + 1), pos // 4 + 1)) AS win, pos FROM cues"),
    "word_gaps": (lambda s, d: _word_gaps(tables.words(s, d)), f"WITH {_WORDS} SELECT track_id, pos, lead(start_ms) OVER (PARTITION BY track_id ORDER BY pos) - (start_ms + dur) AS gap_ms FROM words"),
    "word_clamp": (lambda s, d: track.word_clamp(tables.words(s, d), 500), f"WITH {_WORDS}, x AS (SELECT *, lead(start_ms) OVER (PARTITION BY track_id ORDER BY pos) AS nxt FROM words), y AS (SELECT *, CASE WHEN nxt IS NULL THEN least(start_ms + dur, start_ms + 500) ELSE least(start_ms + dur, start_ms + 500, nxt - 1) END AS c FROM x) SELECT track_id, pos, start_ms, CASE WHEN c > start_ms THEN c ELSE start_ms + dur END AS end_ms FROM y"),
    "frame_targets": (_cue(track.frame_targets), f"WITH {_WORDS}, p AS (SELECT *, CASE WHEN end_ms - start_ms < 400 THEN 30 ELSE 100 END AS pad FROM cues), q AS (SELECT *, least(end_ms, start_ms + pad) AS t0, greatest(start_ms, end_ms - pad) AS t2, (start_ms + end_ms) / 2 AS m FROM p) SELECT track_id, cue_id, slot, CAST(CASE WHEN t0 > t2 OR slot = 'mid' THEN m WHEN slot = 'start' THEN t0 ELSE t2 END AS DOUBLE) AS t_ms FROM q CROSS JOIN (VALUES ('start'), ('mid'), ('end')) s(slot)"),
    "frame_sessions": (_cue(_frame_sessions), f"WITH {_WORDS}, p AS (SELECT *, CASE WHEN end_ms - start_ms < 400 THEN 30 ELSE 100 END AS pad FROM cues), q AS (SELECT *, least(end_ms, start_ms + pad) AS t0, greatest(start_ms, end_ms - pad) AS t2, (start_ms + end_ms) / 2 AS m FROM p), t AS (SELECT track_id, CAST(CASE WHEN t0 > t2 OR slot = 'mid' THEN m WHEN slot = 'start' THEN t0 ELSE t2 END AS DOUBLE) / 1000 AS t_sec FROM q CROSS JOIN (VALUES ('start'), ('mid'), ('end')) s(slot)), x AS (SELECT *, CASE WHEN t_sec - lag(t_sec) OVER (PARTITION BY track_id ORDER BY t_sec) > 1.0::DOUBLE THEN 1 ELSE 0 END AS new FROM t), y AS (SELECT *, CAST(sum(new) OVER (PARTITION BY track_id ORDER BY t_sec RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session FROM x) SELECT track_id, session, min(t_sec) AS first_sec, max(t_sec) AS last_sec, count(*) AS n FROM y GROUP BY track_id, session"),
    "person_area_filter": (lambda s, d: track.person_area(_detections(s, d), 854 * 480, 0.35), f"WITH {_DETECTIONS} SELECT frame_id, count(*) FILTER (person) AS person_count, count(*) FILTER (NOT person) AS non_person_count, round(coalesce(sum(area) FILTER (person), 0) / 409920.0, 4) AS ratio, coalesce(sum(area) FILTER (person), 0) / 409920.0 > 0.35 AS discard FROM d GROUP BY frame_id"),
    "mock_run": (_cue(track.mock_results), f"WITH {_WORDS} SELECT track_id, cue_id, '[MOCK] ' || text AS revised_zh, 1.0::DOUBLE AS confidence, false AS join_with_prev FROM cues"),
    "result_left_join": (_cue(lambda c: track.merge_left(c, _results(c).withColumn("revised_zh", F.when(F.col("revised_zh") != "", F.concat(F.lit(" "), F.md5("revised_zh"), F.lit(" x.. "))).otherwise("")), 0.5)), f"WITH {_WORDS}, {_RESULTS} SELECT c.track_id, c.cue_id, CASE WHEN trim(revised_zh) != '' THEN md5(revised_zh) || ' x' || CASE WHEN confidence < 0.5 THEN '*' ELSE '' END ELSE text END AS text, revised_zh IS NULL AS missing FROM cues c LEFT JOIN r USING (track_id, cue_id)"),
    "resume_anti": (_cue(lambda c: c.join(_results(c).where("revised_zh != ''"), ["track_id", "cue_id"], "left_anti").select("track_id", "cue_id")), f"WITH {_WORDS}, {_RESULTS} SELECT track_id, cue_id FROM cues c WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.track_id = c.track_id AND r.cue_id = c.cue_id AND revised_zh != '')"),
    "srt_render": (_cue(tables.render_srt), f"WITH {_WORDS} SELECT track_id, string_agg((pos + 1) || chr(10) || {_TS.format('start_ms')} || ' --> ' || {_TS.format('end_ms')} || chr(10) || text || chr(10), chr(10) ORDER BY pos) AS content FROM cues GROUP BY track_id"),
    "srt_roundtrip": (_cue(lambda c: tables.parse_srt(tables.render_srt(c))), f"WITH {_WORDS} SELECT track_id, pos, cue_id, start_ms, end_ms, text FROM cues"),
    "anchor_spans": (_cue(lambda c: timing.anchor_spans(_anchored(c), 900)), f"WITH {_WORDS}, a AS (SELECT *, pos % 4 = 2 AND end_ms - start_ms > 1 AS anchored, (pos % 30) / 100.0::DOUBLE AS r0, 1 - (pos % 20) / 100.0::DOUBLE AS r1, end_ms - start_ms AS dur FROM cues), b AS (SELECT *, greatest(start_ms, least(end_ms - 1, start_ms + CAST(round_even(dur * least(r0, r1), 0) AS BIGINT))) AS s FROM a), c AS (SELECT *, greatest(s + 1, least(end_ms, start_ms + CAST(round_even(dur * greatest(r0, r1), 0) AS BIGINT))) AS e FROM b), d AS (SELECT *, greatest(0, 900 - (e - s)) AS need FROM c), g AS (SELECT *, least(s - start_ms, need // 2) AS gl FROM d), h AS (SELECT *, least(end_ms - e, need - gl) AS gr FROM g), k AS (SELECT *, gl + least(s - start_ms - gl, need - gl - gr) AS gl2 FROM h) SELECT track_id, cue_id, CASE WHEN anchored THEN s - gl2 ELSE start_ms END AS start_ms, CASE WHEN anchored THEN e + gr ELSE end_ms END AS end_ms, anchored FROM k"),
    "frame_mode": (_cue(lambda c: timing.frame_mode(c, "Adaptive ", 1.5)), f"WITH {_WORDS} SELECT track_id, cue_id, CASE WHEN end_ms - start_ms <= 1500 THEN 'mid' ELSE 'three' END AS mode FROM cues"),
    "image_policy": (_cue(_policies), f"WITH {_WORDS}, h AS (SELECT track_id, cue_id, cue_id % 5 != 0 AS a, (cue_id + 1) % 5 != 0 AS b, (cue_id + 2) % 5 != 0 AS c FROM cues) SELECT track_id, cue_id, policy, CASE WHEN policy = 'mid' AND b THEN 'mid' WHEN policy = 'three' AND a AND b AND c THEN 'start,mid,end' WHEN policy = 'auto' THEN concat_ws(',', CASE WHEN a THEN 'start' END, CASE WHEN b THEN 'mid' END, CASE WHEN c THEN 'end' END) ELSE '' END AS images, CASE WHEN policy = 'mid' AND NOT b THEN 'missing_mid' WHEN policy = 'three' AND NOT (a AND b AND c) THEN 'missing_three' END AS reason FROM h CROSS JOIN (VALUES ('none'), ('mid'), ('three'), ('auto')) p(policy)"),
    "segment_limits": (_cue(timing.segment_limits), f"WITH {_WORDS}, s AS (SELECT *, (end_ms - start_ms) / 1000.0::DOUBLE AS sec FROM cues) SELECT track_id, cue_id, sec <= 0 OR sec < 5.0::DOUBLE / 6 - 0.001 OR length(text) > 42 OR length(text) / greatest(sec, 1e-9) > 20.001::DOUBLE AS needs_fix, length(text) <= 42 AND NOT regexp_matches(text, '\n|  |[\u2013\u2014]') AS plain_text FROM s"),
    "last_responses": (_cue(_responses), f"WITH {_WORDS}, i AS (SELECT track_id, pos, cue_id, text, unnest(range(greatest(0, CAST(floor((pos - 6) / 4.0) AS BIGINT) + 1), pos // 4 + 1)) AS win FROM cues) SELECT track_id, win, cue_id, CASE WHEN pos % 3 = 0 THEN 'again ' || text WHEN pos % 5 != 0 THEN text END AS revised_zh, CASE WHEN pos % 3 = 0 OR pos % 5 != 0 THEN 'ok' ELSE 'fail' END AS status FROM i"),
    "collapse_repeats": (_cue(lambda c: c.select("track_id", "pos", tx.collapse_repeats(F.col("text")).alias("collapsed"))), None),
    "json_object_lenient": (_object_field, "SELECT event_id AS id, CASE WHEN event_id % 3 < 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events"),
    "normalize_items": (_keyed_items, "SELECT event_id AS id, CAST(event_id AS VARCHAR) AS cue_id, md5(props) AS revised_zh, 0.5::DOUBLE AS confidence FROM events"),
    "merge_results": (_cue(_merged), None),
    "validation_report": (_cue(lambda c: timing.validation_report(c, max_chars=30, max_cps=14.0)), f"WITH {_WORDS}, s AS (SELECT *, (end_ms - start_ms) / 1000.0::DOUBLE AS sec, length(text) AS n, lag(end_ms) OVER (PARTITION BY track_id ORDER BY pos) AS before FROM cues), i AS (SELECT track_id, pos, 1 AS rule, printf('duration %.3fs out of [0.833, 7.000]', sec) AS issue FROM s WHERE sec < 5.0::DOUBLE / 6 - 0.001 OR sec > 7.001 UNION ALL SELECT track_id, pos, 2, 'contains newline (must be single-line)' FROM s WHERE contains(text, chr(10)) UNION ALL SELECT track_id, pos, 3, printf('chars %d > 30', n) FROM s WHERE n > 30 UNION ALL SELECT track_id, pos, 4, printf('cps %.2f > 14.00', n / sec) FROM s WHERE n / sec > 14.001::DOUBLE UNION ALL SELECT track_id, pos, 5, 'contains double spaces' FROM s WHERE contains(text, '  ') UNION ALL SELECT track_id, pos, 6, 'contains en/em dash' FROM s WHERE regexp_matches(text, '[\u2013\u2014]') UNION ALL SELECT track_id, pos, 7, 'overlaps previous cue' FROM s WHERE start_ms < before) SELECT * FROM i"),
    "resegment": (_cue(resegment.resegment), None),
    "split_long": (_cue(lambda c: resegment.split_long(c, resegment.Limits.checked(most=20))), None),
    "resegment_counts": (_cue(resegment.resegment_counts), None),
    "merge_counts": (_cue(lambda c: results.merge_counts(c, _results(c).join(_anchored(c).select("track_id", "cue_id", (F.col("pos") % 3 == 1).alias("join_with_prev"), "has_anchor", "anchor_start_ratio", "anchor_end_ratio"), ["track_id", "cue_id"]), results.Joins.checked(min_confidence=0.5))), None),
    "serial_run": (_cue(lambda c: _serial(c).withColumns({"confidence": F.coalesce("confidence", F.lit(0.0)), "join_with_prev": F.coalesce("join_with_prev", F.lit(False))})), f"WITH {_WORDS}, {_RESULTS}, {_RAN} SELECT track_id, cue_id, CASE WHEN ok THEN '[MOCK] ' || text ELSE revised_zh END AS revised_zh, CASE WHEN ok THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, false AS join_with_prev, CASE WHEN ok THEN 'ok' ELSE 'skipped' END AS status FROM st LEFT JOIN hv USING (track_id, cue_id)"),
    "status_counts": (_cue(lambda c: run.status_counts(_serial(c))), f"WITH {_WORDS}, {_RESULTS}, {_RAN} SELECT track_id, count(*) FILTER (ok) AS ok, 0::BIGINT AS fail, count(*) FILTER (NOT ok) AS skipped, count(*) AS total FROM st GROUP BY track_id"),
    "cue_run": (_cue(run.cue_run), f"WITH {_WORDS} SELECT track_id, cue_id, '[MOCK] ' || text AS revised_zh, 1.0::DOUBLE AS confidence, false AS join_with_prev, 'ok' AS status FROM cues"),
    "history_lookahead": (_cue(_history), f"WITH {_WORDS}, {_RESULTS}, {_HAVE}, s AS (SELECT track_id, pos, pos // 4 AS win FROM cues WHERE pos % 4 = 0) SELECT track_id, win, coalesce((SELECT string_agg(cue_id, ',' ORDER BY cue_id) FROM (SELECT h.cue_id FROM hv h WHERE h.track_id = s.track_id AND h.cue_id <= s.pos ORDER BY h.cue_id DESC LIMIT 6)), '') AS history, coalesce((SELECT string_agg(c.cue_id, ',' ORDER BY c.pos) FROM cues c WHERE c.track_id = s.track_id AND c.pos BETWEEN s.pos + 6 AND s.pos + 7), '') AS lookahead FROM s"),
    "window_images": (_cue(_images), f"WITH {_WORDS}, {_WINDOWS}, g AS (SELECT track_id, win, printf('%06d/', cue_id) || slot AS im FROM i CROSS JOIN (VALUES ('start', 0), ('mid', 1), ('end', 2)) s(slot, o) WHERE (cue_id + o) % 5 != 0) SELECT track_id, win, string_agg(DISTINCT im, ',' ORDER BY im) AS images FROM g GROUP BY track_id, win"),
    "prepare_counts": (_cue(lambda c: run.prepare_counts(c, 5, 60, 20)), f"WITH {_WORDS}, g AS (SELECT track_id, cue_id BETWEEN 5 AND 60 AND end_ms > start_ms AS good FROM cues) SELECT track_id, count(*) AS total, least(20, count(*) FILTER (good)) AS prepared, 0::BIGINT AS skipped FROM g GROUP BY track_id"),
    "refine_counts": (_cue(lambda c: run.refine(c, c, start_id=5, end_id=60).select("track_id", "processed", "failed", "updated_current", "updated_prev", "out_of_range").distinct()), f"WITH {_WORDS} SELECT track_id, count(*) FILTER (cue_id BETWEEN 5 AND 60) AS processed, 0::BIGINT AS failed, 0::BIGINT AS updated_current, 0::BIGINT AS updated_prev, count(*) FILTER (cue_id NOT BETWEEN 5 AND 60) AS out_of_range FROM cues GROUP BY track_id"),
    "refine_run": (_cue(lambda c: run.refine(c, c).select("track_id", "pos", "cue_id", "text")), None),
    "source_lookup": (_cue(_shifted), f"WITH {_WORDS}, s AS (SELECT track_id, pos + 1 AS pos, cue_id + 2 AS cue_id, text FROM cues WHERE pos % 3 != 0) SELECT c.track_id, c.pos, c.cue_id, coalesce(a.text, b.text, '') AS source FROM cues c LEFT JOIN s a ON a.track_id = c.track_id AND a.cue_id = c.cue_id LEFT JOIN s b ON b.track_id = c.track_id AND b.pos = c.pos"),
    "result_defaults": (_cue(_defaults), f"WITH {_WORDS}, {_RESULTS} SELECT track_id, cue_id, CASE WHEN revised_zh = '' THEN 'was ' || cue_id ELSE revised_zh END AS revised_zh, CASE WHEN cue_id % 3 = 0 THEN 0.5::DOUBLE ELSE confidence::DOUBLE END AS confidence, cue_id % 2 = 0 AS join_with_prev, 'ok' AS status FROM r"),
    "cue_prompts": (_cue(_cue_prompts), f"WITH {_WORDS}, {_NEAR}, z AS (SELECT track_id, cue_id, start_ms, end_ms, text, concat_ws(chr(10), {_context_sql('prev', 'prev_')}, {_context_sql('current', '')}, {_context_sql('next', 'next_')}) AS context FROM nb) SELECT track_id, cue_id, context, length(concat_ws(chr(10), 'Revise the Chinese subtitle of one cue; times stay as they are.', 'One frame (mid) comes with this cue.', 'cue_id: ' || cue_id, 'time: ' || {_TS.format('start_ms')} || ' --> ' || {_TS.format('end_ms')}, 'source: ' || text, 'current: ', 'context:', context, 'Keep names in English. Answer with one JSON object of the given schema.')) AS n FROM z"),
    "refine_prompts": (_cue(_refine_prompts), f"WITH {_WORDS}, {_NEAR} SELECT track_id, cue_id, concat_ws(chr(10), 'Refine the flow between cues; the focus is cue ' || cue_id || '.', {_refine_sql('prev', 'prev_')}, {_refine_sql('current', '')}, {_refine_sql('next', 'next_')}, 'The next cue must not change. Answer with one JSON object of the given schema.') AS prompt FROM nb"),
    "window_prompts": (_cue(_window_prompts), f"WITH {_WORDS}, {_WINDOWS} SELECT track_id, win, concat_ws(chr(10), 'Translate the cues of this window together.', 'history:', '- <none>', 'window:', string_agg('- cue ' || cue_id || ' ' || {_span()} || chr(10) || '  EN: ' || {_CLIP.format('text')} || chr(10) || '  current_zh: ', chr(10) ORDER BY pos), 'next, not to be answered:', '- <none>', 'images, in this order:', '- <none>', 'Answer with one JSON item for each of: [' || string_agg(cue_id, ', ' ORDER BY pos) || ']') AS prompt FROM i GROUP BY track_id, win"),
    "detection_report": (_listed, "SELECT l_orderkey AS frame_id, string_agg(CASE WHEN l_returnflag = 'R' THEN 'person' ELSE 'car' END || ' ' || printf('%.2f', l_quantity / 100) || ' ' || printf('%.4f', round_even(CAST(trunc(l_quantity) AS INT) * 10 * CAST(trunc(l_quantity) AS INT) * 8 / 409920.0::DOUBLE, 4)), '; ' ORDER BY l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'person' ELSE 'car' END, l_quantity) AS detections FROM lineitem GROUP BY l_orderkey"),
    "frame_totals": (lambda s, d: track.frame_totals(track.person_area(_detections(s, d), 854 * 480, 0.35), 0.35), f"WITH {_DETECTIONS}, v AS (SELECT frame_id, coalesce(sum(area) FILTER (person), 0) / 409920.0 > 0.35 AS discard FROM d GROUP BY frame_id) SELECT count(*) AS total, count(*) FILTER (NOT discard) AS kept, count(*) FILTER (discard) AS discarded, 0.35::DOUBLE AS threshold FROM v"),
    "split_frames": (lambda s, d: track.split_frames(_detections(s, d).select("frame_id").distinct(), track.person_area(_detections(s, d), 854 * 480, 0.35)), f"WITH {_DETECTIONS} SELECT frame_id, coalesce(sum(area) FILTER (person), 0) / 409920.0 > 0.35 AS skipped FROM d GROUP BY frame_id"),
    "missing_frames": (_cue(lambda c: track.missing_frames(track.frame_targets(c), track.frame_targets(c).where("(cue_id + length(slot)) % 2 = 0")).select("track_id", "cue_id", "slot")), f"WITH {_WORDS} SELECT track_id, cue_id, slot FROM cues CROSS JOIN (VALUES ('start'), ('mid'), ('end')) s(slot) WHERE (cue_id + length(slot)) % 2 != 0"),
    "frame_targets_by_mode": (_cue(lambda c: track.frame_targets(c.withColumn("mode", F.when(F.col("cue_id") % 3 == 0, "none").when(F.col("cue_id") % 3 == 1, "mid").otherwise("three"))).select("track_id", "cue_id", "slot")), f"WITH {_WORDS} SELECT track_id, cue_id, slot FROM cues CROSS JOIN (VALUES ('start'), ('mid'), ('end')) s(slot) WHERE cue_id % 3 = 2 OR cue_id % 3 = 1 AND slot = 'mid'"),
    "frame_indices": (_cue(_points), f"WITH {_WORDS}, {_SESSIONS}, k AS (SELECT *, greatest(0.0::DOUBLE, min(t_sec) OVER (PARTITION BY track_id, session) - 1.0::DOUBLE) AS seek FROM y) SELECT track_id, session, least(499, greatest(0, CAST(round_even((t_sec - seek) * 10.0::DOUBLE, 0) AS BIGINT))) AS frame, count(*) AS n FROM k GROUP BY ALL"),
    "punctuation_blocks": (lambda s, d: track.punctuation_blocks(tables.words(s, d)), rf"WITH {_WORDS}, x AS (SELECT track_id, pos, word, regexp_replace(word, '^[^\p{{L}}\p{{M}}\p{{N}}_'']+|[^\p{{L}}\p{{M}}\p{{N}}_'']+$', '', 'g') AS b FROM words) SELECT track_id, pos // 180 AS block, count(*) AS n_words, string_agg(CASE WHEN b != '' THEN b ELSE word END, ' ' ORDER BY pos) AS text FROM x GROUP BY track_id, pos // 180"),
    "punctuation_applied": (lambda s, d: track.punctuated(tables.words(s, d).select("track_id", "pos", "word"), track.punctuation_blocks(tables.words(s, d)).select("track_id", "block", F.when(F.col("block") % 2 == 0, F.regexp_replace("text", "\\S+", "$0!")).otherwise(F.concat("text", F.lit(" more"))).alias("text"))), rf"WITH {_WORDS}, x AS (SELECT track_id, pos, word, regexp_replace(word, '^[^\p{{L}}\p{{M}}\p{{N}}_'']+|[^\p{{L}}\p{{M}}\p{{N}}_'']+$', '', 'g') AS b FROM words) SELECT track_id, pos, CASE WHEN pos // 180 % 2 = 1 THEN word WHEN b != '' THEN b || '!' ELSE word || '!' END AS word FROM x"),
    "aligned_words": (_aligned, f"WITH {_WORDS} SELECT track_id, pos, word, start_ms / 1000.0::DOUBLE AS start, (start_ms + dur) / 1000.0::DOUBLE AS end FROM words"),
    "word_classes": (_classes, f"WITH {_WORDS}, x AS (SELECT track_id, pos, {_BARE.format('word')} AS n FROM words) SELECT track_id, pos, n, {_VERB} AS verb, {_ends('n', _L.ADJECTIVE_ENDS)} AS adjective, {_NOUN} AS noun FROM x"),
    "clean_text": (_cue(lambda c: c.select("track_id", "pos", lexical.clean(_padded_text(F.col("text"))).alias("cleaned"))), f"WITH {_WORDS}, x AS (SELECT track_id, pos, '  ( ' || text || ' ) ,  it ''s \u2014 so  .' AS t FROM cues) SELECT track_id, pos, {_CLEAN} AS cleaned FROM x"),
    "join_text": (_cue(lambda c: c.select("track_id", "pos", tx.join_text(F.col("text"), F.coalesce(F.lead("text").over(track.by_track()), F.lit(""))).alias("joined"))), f"WITH {_WORDS}, x AS (SELECT track_id, pos, text AS a, coalesce(lead(text) OVER (PARTITION BY track_id ORDER BY pos), '') AS b FROM cues) SELECT track_id, pos, CASE WHEN b != '' AND regexp_matches(a, '[A-Za-z0-9]$') AND regexp_matches(b, '^[A-Za-z0-9]') THEN a || ' ' || b ELSE a || b END AS joined FROM x"),
    "srt_timestamp": (_cue(lambda c: c.select("track_id", "pos", tx.seconds_to_ts(F.col("start_ms") / 1000 + 0.0003).alias("ts"))), f"WITH {_WORDS} SELECT track_id, pos, {_TS.format('start_ms')} AS ts FROM cues"),
    "mark_low": (_cue(lambda c: c.select("track_id", "pos", tx.mark(F.concat("text", F.lit(" * *")), F.col("pos") % 2 == 0).alias("line"), tx.marked(F.concat("text", F.lit("* "))).alias("was"))), f"WITH {_WORDS} SELECT track_id, pos, text || CASE WHEN pos % 2 = 0 THEN '*' ELSE '' END AS line, true AS was FROM cues"),
    "srt_seconds": (_cue(lambda c: files.render_seconds(c.select("track_id", F.col("pos").alias("idx"), (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), "text"))), f"WITH {_WORDS} SELECT track_id, string_agg((pos + 1) || chr(10) || {_TS.format('start_ms')} || ' --> ' || {_TS.format('end_ms')} || chr(10) || text || chr(10) || chr(10), '' ORDER BY pos) AS srt, string_agg(text, chr(10) ORDER BY pos) || chr(10) AS txt FROM cues GROUP BY track_id"),
    "task_metas": (_cue(lambda c: files.task_metas(c).select("track_id", "cue_id", F.get_json_object("meta", "$.start").alias("start"), F.get_json_object("meta", "$.src_text").alias("src_text"))), f"WITH {_WORDS} SELECT track_id, cue_id, {_TS.format('start_ms')} AS start, text AS src_text FROM cues"),
    "ndjson_items": (_event_lines, "SELECT event_id AS id, CAST(event_id AS VARCHAR) AS cue_id, md5(props) AS revised_zh FROM events"),
    "dp_segments": (_finished, None),
    "segment_report": (_segment_report, None),
    "boundary_cost": (lambda s, d: segment.borders(tables.words(s, d)).select("track_id", "pos", F.bround("border", 4).alias("border")), f"WITH {_WORDS}, {_BORDER} SELECT track_id, pos, round_even(border, 4) AS border FROM b"),
    "dp_candidates": (_candidates, f"WITH {_WORDS}, {_BORDER}, {_CANDIDATES} SELECT track_id, i, j, text, chars, round_even(planned, 3) AS planned, round_even(0.00003::DOUBLE + 1.0::DOUBLE + border + greatest(0, chars / planned - 17.6::DOUBLE) * 1.4::DOUBLE + greatest(0, chars - 37.8::DOUBLE) * 0.08::DOUBLE + greatest(0, 5.0::DOUBLE / 6 + 0.18::DOUBLE - planned) * 0.9::DOUBLE, 3) AS cost FROM c3 WHERE chars / planned <= 20.000001::DOUBLE"),
}


def queries() -> dict:
    return {k: q for k, (q, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _QUERIES.items() if sql}
