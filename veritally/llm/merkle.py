"""Document fingerprints: a Merkle tree over clauses, paragraphs and sections.

A line is a paragraph. Its clauses, cut after a sign and a space or after 64 code points, are the leaves; a
paragraph's node covers its leaves, a section's node its paragraphs, the root all sections. A
section ends after a paragraph whose node begins with one of ``SECTION_ENDS``, so the content sets
its borders and an insertion changes one section, not all later ones.

Equal roots mean equal texts; where roots differ, unequal section nodes and in them unequal leaves locate the edit.
The likeness of two trees is the share of leaves they have in common (Jaccard over distinct leaves).

A NULL text counts as the empty one, a tree of one empty leaf. Rows that repeat a doc_id come in the order of their
texts; a NULL doc_id is the smallest. In a table of one row, that row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import BITMAP_BITS, bitmap_of, bitmap_value, is_set, is_small
from veritally.workspace import materialize

CLAUSE_END = r"([.!?,;:]) "
CLAUSE_LIMIT = r"([^\n]{64})"
SECTION_ENDS = "0123"  # of 16 hex digits: a section has four paragraphs on average
NODE = 8  # hex digits of a section or leaf as it is written; nodes cover whole digests
SEPARATOR = ","
COARSE = 32
ROWS_PER_BUCKET = 500
LOWEST = -(1 << 63)


def _node(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _short(nodes: str) -> Column:
    return F.transform(nodes, lambda n: F.substring(n, 1, NODE))


def _leaves(paragraph: Column) -> Column:
    cut = F.regexp_replace(F.regexp_replace(paragraph, CLAUSE_END, "$1\n"), CLAUSE_LIMIT, "$1\n")
    return F.transform(F.split(cut, "\n"), _node)


def _tree_columns(text: Column) -> list[tuple[str, Column]]:
    """The steps from a text to its tree, each over the columns before it."""
    ended = lambda node: F.substring(node, 1, 1).isin(*SECTION_ENDS)
    join = lambda nodes: F.array_join(nodes, SEPARATOR)
    return [
        ("_grouped", F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _leaves)),
        ("_paragraphs", F.transform("_grouped", lambda leaves: _node(join(leaves)))),
        ("_marked", F.array_join(F.transform("_paragraphs", lambda n: F.concat(n, F.when(ended(n), "|").otherwise(SEPARATOR))), "")),
        ("_nodes", F.transform(F.split("_marked", r"\|"), _node)),
    ]


def with_tree(rows: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Add <prefix>root, <prefix>sections and <prefix>leaves of a text column; columns of these names are replaced.

    The root covers whole digests, so equal roots mean equal texts; section and leaf nodes are written short.
    """
    added = [prefix + c for c in ("root", "sections", "leaves")]
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in added]
    steps = rows.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
    for name, column in _tree_columns(F.col("text")):
        steps = steps.withColumn(name, column)
    root = F.sha2(F.array_join("_nodes", SEPARATOR).cast("binary"), 256)
    return steps.select(
        "row", root.alias("root"), _short("_nodes").alias("sections"), F.transform(F.flatten("_grouped"), lambda n: F.substring(n, 1, NODE)).alias("leaves")
    ).select("row.*", *(F.col(c).alias(prefix + c) for c in ("root", "sections", "leaves")))


def fingerprint(prefix: str = "") -> Column:
    """A tree as one string: root, section nodes and leaves."""
    return F.concat_ws(
        ":", F.col(f"{prefix}root"), *(F.array_join(f"{prefix}{c}", SEPARATOR) for c in ("sections", "leaves"))
    )


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: 1 for equal roots, else the Jaccard similarity of their distinct leaves, which counts as one leaf
    short of 1 if only their order or grouping differs."""
    one, two = (F.split(F.substring_index(x, ":", -1), SEPARATOR) for x in (a, b))
    shared = F.size(F.array_intersect(one, two))
    every = F.size(F.array_union(one, two))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.lit(1.0)).otherwise(
        shared / (every + (shared == every).cast("int"))
    )


def edited_branches(before: DataFrame, after: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sections, leaves) of the documents that changed: the numbers, from 0 and in ``after``, of the sections and leaves
    that ``before`` does not have. Documents in one table only are left out; equal roots are ruled out first."""
    old = with_tree(before.select(key, F.col(text).alias("_text")), "_text", "old_").drop("_text")
    new = with_tree(after.select(key, F.col(text).alias("_text")), "_text", "new_").drop("_text")
    changed = old.join(new, key).where("old_root <> new_root")
    unknown = lambda what: F.filter(
        F.transform(f"new_{what}", lambda n, i: F.when(~F.array_contains(f"old_{what}", n), i)), lambda i: i.isNotNull()
    )
    return changed.select(key, unknown("sections").alias("sections"), unknown("leaves").alias("leaves"))


def _buckets(order: DataFrame) -> tuple[Column, Column]:
    """Bucket and coarse bucket of the long column ``_k``, both growing with it.

    Coarse bounds are percentiles, finer ones cut the range between two of them evenly; so buckets stay small for
    dense, hashed and clustered ids alike. The driver gets one row of ``COARSE`` numbers.
    """
    shares = [i / COARSE for i in range(COARSE + 1)]
    got = order.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_k", shares, 10_000).alias("at")).first()
    bounds = sorted(set(got["at"] or [0, 0]))
    fine = max(1, -(-got["n"] // (COARSE * ROWS_PER_BUCKET)))
    k = F.col("_k")

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(k < F.lit(bounds[mid]), search(lo, mid - 1)).otherwise(search(mid, hi))

    coarse = search(0, len(bounds) - 1)
    low = F.get(F.lit([float(b) for b in bounds]), coarse)
    high = F.get(F.lit([float(b) for b in bounds[1:] + bounds[-1:]]), coarse)
    step = F.floor((k.cast("double") - low) / (high - low + F.lit(1.0)) * F.lit(fine))
    return coarse * F.lit(fine) + F.greatest(F.lit(0), F.least(step, F.lit(fine - 1))), coarse


def with_next(rows: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """Add next_<c> for each carried column: that of the next row by descending ``key``, after the last one the first.

    Rows are cut into buckets of neighbouring keys and sorted inside them, with one shuffle. The first row of each bucket
    also goes, as a guest, behind the last row of the bucket before it.
    """
    marked = rows.withColumn("_k", F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)))
    bucket, coarse = _buckets(marked.select("_k"))
    placed = marked.withColumns({"_bucket": bucket.cast("long"), "_coarse": coarse.cast("int")})
    heads = materialize(placed.groupBy("_bucket", "_coarse").agg(F.max("_k").alias("_k")), "heads")
    in_coarse = Window.partitionBy("_coarse").orderBy("_bucket")
    tops = heads.groupBy("_coarse").agg(F.max("_bucket").alias("_top"))
    tops = tops.select(
        "_coarse",
        F.coalesce(F.lag("_top").over(Window.orderBy("_coarse")), F.max("_top").over(Window.partitionBy())).alias("_below"),
    )
    follows = heads.join(F.broadcast(tops), "_coarse").select(
        F.col("_bucket").alias("_host"), F.coalesce(F.lag("_bucket").over(in_coarse), "_below").alias("_bucket")
    )
    order = [F.col("_k").desc(), *(F.col(c).desc() for c in carried)]
    first = _rows_of(placed, heads).withColumn("_n", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    guests = (
        first.where("_n = 1").drop("_n").join(follows, "_bucket").withColumn("_bucket", F.col("_host")).drop("_host")
    )
    both = placed.withColumn("_guest", F.lit(False)).unionByName(guests.withColumn("_guest", F.lit(True)))
    w = Window.partitionBy("_bucket").orderBy("_guest", *order)
    return (
        both.withColumns({f"next_{c}": F.lead(c).over(w) for c in carried})
        .where(~F.col("_guest"))
        .drop("_k", "_bucket", "_coarse", "_guest")
    )


def _rows_of(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The rows with a key in ``heads``; a long list first rules out most rows by a bitmap of fixed size."""
    listed = heads.select("_k")
    if is_small(listed):
        return rows.join(F.broadcast(listed), "_k", "left_semi")
    bitmap = bitmap_of(listed.select(F.xxhash64("_k").alias("h")), "h")
    return rows.where(is_set(bitmap_value(rows.sparkSession, bitmap), BITMAP_BITS, F.xxhash64("_k"))).join(listed, "_k", "left_semi")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``documents``, of its edited text, and their likeness."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_tree(texts, "text").select("doc_id", "text", fingerprint().alias("fingerprint"))
    pairs = with_next(own, "doc_id", ["text", "fingerprint"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    trees = with_tree(pairs.withColumn("_edited", edited).drop("text", "next_text"), "_edited", "edited_")
    return trees.withColumn("edited_fingerprint", fingerprint("edited_")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
