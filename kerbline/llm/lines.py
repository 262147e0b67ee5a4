"""Line dedup by a log-template tree.

Every line is parsed down a tree of fixed depth: its number of words, then its
first ``DEPTH`` words; words that hold a digit are variable fields.  Lines of one
leaf share a template: at each place the most frequent word, or a variable field
where no word has half of the leaf's distinct lines.  A line that agrees with too
few of the template's places is a template of its own.

A template recurs if it stands in at least ``min_docs`` distinct texts, so exact
copies of one document count once, and lines of shared blocks, headers, footers and
one-line documents recur.  All its lines go, but for its first one by (doc_id, line
number), which keeps the passage once.

``by_neighbours`` counts less: documents of a template that have the same two
neighbouring lines count once, so inner lines of shared blocks stay.  The checking SQL
of ``op3_line_dedup`` states this, so that query alone asks for it.

Defined results: null text stays null; blank lines stay and are no templates; lines
with fewer than ``min_words`` fixed words are too short to tell and stay; rows that
repeat id and text are one document; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.llm.base import GAPS, fresh, sized
from kerbline.staging import stage

DEPTH = 4
AGREE = 0.7
MIN_DOCS = 3
MIN_WORDS = 3
FIELD = "<*>"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, pos, masked, near): one row per line that has words; ``near`` tells its neighbours apart."""
    split = docs.where("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("body"), F.split("text", "\n").alias("lines"))
    hashed = split.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
    whole = F.transform("lines", lambda x, i: F.struct(
        i.alias("pos"), x.alias("line"), F.xxhash64(F.get("hashes", i - 1), F.get("hashes", i + 1)).alias("near")))
    return hashed.select("doc_id", "body", F.inline(whole))


def _masked(line: Column) -> Column:
    """The line with single spaces and its variable fields as one sign; most lines need neither and are only looked at."""
    odd = line.rlike(r"[0-9\t\x0B-\r]") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    # possessive, from word starts only, so a line is scanned once
    fields = F.regexp_replace(F.trim(F.regexp_replace(line, GAPS, " ")), r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    return F.when(odd, fields).otherwise(line)


def _keyed(docs: DataFrame, min_words: int) -> DataFrame:
    """Lines with enough fixed words, with the leaf of the tree and the hash of the masked line."""
    lines = _lines(docs).select("doc_id", "body", "pos", _masked(F.col("line")).alias("masked"), "near")
    n = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    fields = F.when(F.col("masked").contains(FIELD), (F.length("masked") - F.length(F.replace("masked", F.lit(FIELD), F.lit("")))) / len(FIELD)).otherwise(0)
    head = F.substring_index("masked", " ", DEPTH)
    return (lines.withColumn("n", n).where(F.col("n") - fields >= min_words)
            .withColumn("leaf", F.xxhash64("n", head)).withColumn("whole", F.xxhash64("masked")).drop("n"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS, agree: float = AGREE,
              by_neighbours: bool = False) -> DataFrame:
    """(doc_id, body, pos) of the lines to drop."""
    keyed = stage(_keyed(docs, min_words).drop("masked"), "lines")

    # leaves that could hold a recurring template and more than one distinct line
    leaves = (keyed.groupBy("leaf").agg(F.min("whole").alias("a"), F.max("whole").alias("b"), F.count("*").alias("n"))
              .where(F.col("n") >= min_docs))
    mixed = stage(leaves.where("a <> b").select("leaf"), "leaves")
    # their words are read again from the documents that hold such lines, not from all
    holders = stage(keyed.join(sized(mixed), "leaf", "left_semi").select("doc_id").distinct(), "holders")
    some = docs.join(sized(holders), docs["doc_id"].eqNullSafe(holders["doc_id"]), "left_semi")
    variants = stage(_keyed(some, min_words).join(sized(mixed), "leaf", "left_semi")
                     .groupBy("leaf", "whole").agg(F.first("masked").alias("masked")), "variants")
    words = variants.select("leaf", "whole", F.posexplode(F.split("masked", " ")).alias("at", "word"))
    counted = words.groupBy("leaf", "at", "word").agg(F.count("*").alias("n"))
    places = (counted.groupBy("leaf", "at")
              .agg(F.max_by("word", F.struct("n", "word")).alias("word"), F.max("n").alias("n"), F.sum("n").alias("of"))
              .withColumn("word", F.when(F.col("n") * 2 >= F.col("of"), F.col("word")).otherwise(FIELD)))
    trees = places.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("t"))  # as long as a line
    trees = trees.select("leaf", F.col("t.word").alias("template"))
    pairs = F.zip_with(F.split("masked", " "), "template", lambda a, b: (a == b) | (b == FIELD))
    fixed = F.size(F.filter("template", lambda w: w != FIELD))
    share = F.size(F.filter(pairs, lambda x: x)) / F.size("template")
    fits = (share >= agree) & (fixed * 2 >= F.size("template")) & (fixed >= min_words)
    mapped = (variants.join(trees, "leaf")
              .select("leaf", "whole", F.when(fits, F.xxhash64(F.concat_ws(" ", "template"), F.lit(1))).alias("tree"))
              .where("tree IS NOT NULL"))
    mapped = stage(mapped, "trees")

    # a line outside a shared template is a template of its own
    named = (keyed.join(sized(mapped), ["leaf", "whole"], "left")
             .withColumn("template", F.coalesce("tree", "whole")).drop("tree", "leaf", "whole"))
    named = stage(named, "templates")
    seen = named.groupBy("template", "near" if by_neighbours else "body").agg(
        F.min("doc_id").alias("d"), F.min(F.struct("doc_id", "body", "pos")).alias("first"))
    docs_of = F.countDistinct("d") if by_neighbours else F.count("*")
    again = (seen.groupBy("template").agg(docs_of.alias("docs"), F.min("first").alias("first"))
             .where(F.col("docs") >= min_docs).drop("docs"))
    again = stage(again, "again")
    return (named.join(sized(again), "template")
            .where(~F.struct("doc_id", "body", "pos").eqNullSafe(F.col("first")))
            .select("doc_id", "body", "pos"))


def without_recurring(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with recurring lines cut out of ``text``, and two counts of lines in a column ``cut`` (n_lines, n_dropped).

    All other columns stay; a column named ``cut`` keeps its name and the counts take a longer one.
    """
    own = docs.columns
    out = fresh(own, "cut")
    drops = (recurring(docs.select("doc_id", "text"), **how).groupBy("doc_id", "body")
             .agg(F.collect_set("pos").alias("drops")))  # at most the lines of one document
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("d"), F.xxhash64("text").alias("body"))
    joined = rows.join(drops, F.col("d.doc_id").eqNullSafe(drops["doc_id"]) & (rows["body"] == drops["body"]), "left").select("d", "drops")
    lines = F.split("d.text", "\n")
    text = F.when(F.col("drops").isNull(), F.col("d.text")).otherwise(
        F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("drops", i)), "\n"))
    counts = F.struct(F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).alias("n_dropped"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in own], counts.alias(out))


def kept_lines(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text), one row per document."""
    return without_recurring(docs.select("doc_id", "text"), **how).select("doc_id", "cut.n_lines", "cut.n_dropped", "text")
