"""Queries over the given tables, one per operator, with checking SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.llm import (
    chat, decontamination, fingerprints, language, lines, manifest, minhash, mixing, negatives, quality, scoring, toxicity, urls)
from kerbline.llm.base import held_out, table


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_near_dedup(spark, sf_dir):
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Likeness(words=4, percent=80))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op3_line_dedup(spark, sf_dir):
    """As LINES_SQL states it, documents count by their neighbouring lines; the pipeline counts distinct texts."""
    return lines.kept_lines(table(spark, sf_dir, "documents"), by_neighbours=True)


def op4_chat_format(spark, sf_dir):
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op6_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language.predictions(docs, language.train(docs))
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "rejected")


def op7_decontamination(spark, sf_dir):
    return decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_url_filter(spark, sf_dir):
    """The number in a url's path is the document that the page shows; bad or toxic documents label their urls for blocking."""
    pages = table(spark, sf_dir, "pages")
    shown = pages.select("url", F.expr("try_cast(regexp_extract(url, '://[^?#]*?/([0-9]+)', 1) AS BIGINT)").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    verdict = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    return urls.judged(pages, shown.join(labels.select("doc_id", verdict.alias("verdict")), "doc_id").select("url", "verdict"))


def op10_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_lm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scoring.scores(docs, scoring.train(docs.where(~held_out(5, 1))))


def op12_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return manifest.verified(docs, manifest.lower_case_tampering(docs, every=5))


def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_near_dedup, op3_line_dedup, op4_chat_format, op5_fingerprints, op6_language, op7_decontamination,
    op8_quality, op9_url_filter, op10_mixing, op11_lm_scores, op12_manifest, op13_hard_negatives)}

MIXING_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS weight
  FROM per),
filled AS (
  SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS capped, sum(weight) OVER after AS open_weight,
         sum(source_size) OVER () AS whole
  FROM ranked
  WINDOW before AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
unit AS (
  SELECT (1.5::DOUBLE * whole::DOUBLE - capped::DOUBLE) / open_weight::DOUBLE AS u FROM filled
  WHERE (1.5::DOUBLE * whole::DOUBLE - capped::DOUBLE) / open_weight::DOUBLE * weight <= 2 * source_size
  ORDER BY 2 * source_size / weight, source LIMIT 1),
targets AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), coalesce((SELECT u FROM unit), 1e300) * weight) AS target FROM ranked),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
tries AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, r.rate, j.seed,
         s.size * (CAST(floor(r.rate) AS BIGINT) + CASE WHEN CAST(('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), 'null') || ':' || j.seed), 1, 8))
           AS BIGINT) / 4294967296.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS taken
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN (SELECT unnest(range(16)) AS seed) j),
best AS (
  SELECT source, arg_min(seed, (miss, seed)) AS seed
  FROM (SELECT source, seed, abs(sum(taken) - any_value(target)) AS miss FROM tries GROUP BY source, seed) GROUP BY source)
SELECT t.doc_id, t.size, t.source_size, t.target, CAST(t.taken AS BIGINT) AS taken
FROM tries t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.seed = b.seed
"""

LINES_SQL = """
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
every AS (SELECT doc_id, ls, unnest(range(len(ls))) AS pos FROM cut WHERE text IS NOT NULL),
placed AS (SELECT doc_id, pos, coalesce(CASE WHEN pos > 0 THEN ls[pos] END, chr(0)) || chr(1) || coalesce(ls[pos + 2], chr(0)) AS near,
                  list_transform(regexp_extract_all(ls[pos + 1], '[^\\x20\\x09-\\x0D]+'),
                                 lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS ws FROM every),
keyed AS (SELECT doc_id, pos, near, ws, len(ws) || chr(2) || array_to_string(ws[1:4], ' ') AS leaf, array_to_string(ws, ' ') AS whole
          FROM placed WHERE len(list_filter(ws, lambda w: w <> '<*>')) >= 3),
mixed AS (SELECT leaf FROM keyed GROUP BY leaf HAVING count(*) >= 3 AND min(whole) <> max(whole)),
variants AS (SELECT DISTINCT leaf, whole, ws FROM keyed WHERE leaf IN (SELECT leaf FROM mixed)),
words AS (SELECT leaf, unnest(range(len(ws))) AS place, unnest(ws) AS word FROM variants),
counted AS (SELECT leaf, place, word, count(*) AS n FROM words GROUP BY ALL),
places AS (SELECT leaf, place, CASE WHEN max(n) * 2 >= sum(n) THEN arg_max(word, (n, word)) ELSE '<*>' END AS word FROM counted GROUP BY leaf, place),
trees AS (SELECT leaf, list(word ORDER BY place) AS t FROM places GROUP BY leaf),
mapped AS (
  SELECT v.leaf, v.whole, chr(3) || array_to_string(t, ' ') AS tree FROM variants v JOIN trees USING (leaf)
  WHERE len(list_filter(range(len(t)), lambda i: t[i + 1] = '<*>' OR t[i + 1] = v.ws[i + 1])) >= 0.7 * len(t)
    AND len(list_filter(t, lambda w: w <> '<*>')) * 2 >= len(t) AND len(list_filter(t, lambda w: w <> '<*>')) >= 3),
named AS (SELECT k.doc_id, k.pos, k.near, coalesce(m.tree, k.whole) AS template FROM keyed k LEFT JOIN mapped m USING (leaf, whole)),
seen AS (SELECT template, near, min(doc_id) AS d, min((doc_id, pos)) AS first FROM named GROUP BY template, near),
again AS (SELECT template, min(first) AS first FROM seen GROUP BY template HAVING count(DISTINCT d) >= 3),
drops AS (SELECT n.doc_id, list(n.pos) AS ps FROM named n JOIN again a USING (template) WHERE (n.doc_id, n.pos) <> a.first GROUP BY n.doc_id)
SELECT c.doc_id, CAST(coalesce(len(c.ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(d.ps), 0) AS INTEGER) AS n_dropped,
       CASE WHEN d.ps IS NULL THEN c.text ELSE array_to_string(
         list_transform(list_filter(range(len(c.ls)), lambda i: NOT list_contains(d.ps, i)), lambda i: c.ls[i + 1]), chr(10)) END AS text
FROM cut c LEFT JOIN drops d USING (doc_id)
"""

CHAT_SQL = """
WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(1) || text || chr(2), '' ORDER BY turn, role, sha256(role || chr(0) || text)) AS flat,
         string_agg('<|im_start|>' || role || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), ''
                    ORDER BY turn, role, sha256(role || chr(0) || text)) AS text
  FROM rows GROUP BY conv_id),
once AS (SELECT flat, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS copies, any_value(text) AS text FROM whole GROUP BY flat)
SELECT conv_id, CAST(n_turns AS INTEGER) AS n_turns, copies, text FROM once o
WHERE NOT EXISTS (SELECT 1 FROM once l WHERE l.n_turns > o.n_turns AND starts_with(l.flat, o.flat))
"""

NEAR_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM worded),
sized AS (SELECT doc_id, s, CAST(coalesce(len(s), 0) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS m
         FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met WHERE 100 * m >= 80 * (an + bn - m)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT DISTINCT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
parts AS (SELECT doc_id, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id FROM sized)
SELECT s.doc_id, s.n AS n_shingles, p.component_id, s.doc_id = p.component_id AS kept FROM sized s JOIN parts p USING (doc_id)
"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""


def _forest_sql(name: str, levels: int) -> str:
    """Levels, runs and paths over ``{name}0`` (tree, i, n, h), for up to 16 ** ``levels`` leaves a tree."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
  SELECT tree, i // 16 AS i, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h
  FROM {name}{k} GROUP BY tree, i // 16, n)""")
        out.append(f"""{name}s{k} AS (
  SELECT tree, i, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM {name}{k} WINDOW w AS (PARTITION BY tree, i // 16 ORDER BY i))""")
    joins = " ".join(f"JOIN {name}s{k} s{k} ON s{k}.tree = l.tree AND s{k}.i = l.i // {16 ** k}" for k in range(levels))
    columns = ", ".join(f"s{k}.n AS n{k}, s{k}.b AS b{k}, s{k}.a AS a{k}" for k in range(levels))
    out.append(f"{name}paths AS (SELECT l.tree, l.i, r.h AS root, {columns} FROM {name}0 l {joins} JOIN {name}{levels} r ON r.tree = l.tree)")
    return ",\n".join(out)


def _manifest_sql(levels: int = 4, upper: int = 2) -> str:
    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    steps, before = [], "changed"
    for path, depth in (("p", levels), ("q", upper)):
        for k in range(depth):
            steps.append(f"f{path}{k} AS (SELECT *, CASE WHEN {path}n{k} > 1 THEN sha256({path}b{k} || {before} || {path}a{k}) ELSE {before} END AS "
                         f"{path}f{k} FROM {'whole' if not steps else last})")
            last, before = f"f{path}{k}", f"{path}f{k}"
    sides = [f"{path}b{k} || {path}a{k}" for path, depth in (("p", levels), ("q", upper)) for k in range(depth)]
    columns = [f"{path}.{c}{k} AS {path}{c}{k}" for path, depth in (("p", levels), ("q", upper)) for k in range(depth) for c in "nba"]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH bytes AS (
  SELECT *, coalesce(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 0) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE ':' || source END AS tree, {leaf('text')} AS h,
         CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS changed
  FROM bytes),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
s0 AS (SELECT tree, i, n, h FROM ranked),
{_forest_sql('s', levels)},
t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h, tree AS of FROM s{levels}),
{_forest_sql('t', upper)},
whole AS (
  SELECT r.doc_id, r.h AS leaf, r.changed, p.root AS subroot, q.root AS root, {', '.join(columns)}
  FROM ranked r JOIN spaths p ON p.tree = r.tree AND p.i = r.i JOIN t0 u ON u.of = r.tree JOIN tpaths q ON q.i = u.i),
{(','+chr(10)).join(steps)}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(sides)}) AS proof_sha256, {before} AS folded_root, {before} = root AS verified FROM {last}
"""


MANIFEST_SQL = _manifest_sql()

ORACLES = {"op12_manifest": MANIFEST_SQL, "op13_hard_negatives": NEGATIVES_SQL, "op2_near_dedup": NEAR_SQL, "op3_line_dedup": LINES_SQL, "op4_chat_format": CHAT_SQL, "op10_mixing": MIXING_SQL}
