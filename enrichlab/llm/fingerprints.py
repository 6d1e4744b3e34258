"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text, in DataFrame functions only.

A text is split into sections at blank lines and into paragraphs at line ends; a paragraph is made of pieces, which
end at punctuation or after ``PIECE`` characters.  Nothing is left out, so a text can be put together again from its
tree, and the digests of the nodes follow: piece, paragraph (its pieces), section (its paragraphs), root (its sections).
Equal texts have equal roots, other texts other roots.  A fingerprint writes the tree down in short: the root, then
per section and paragraph the first ``MARK`` digits of its pieces' digests.

Likeness is the Dice coefficient of the two texts' distinct marks; branches that differ tell where an edit lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichlab.llm.common import stored
from enrichlab.operators.binning import range_bucket_expr

#: Characters of a piece before its closing punctuation, and hex digits that a fingerprint keeps of a piece's digest.
PIECE, MARK = 48, 8
PIECES = rf"[^.,;:!?|]{{1,{PIECE}}}[.,;:!?|]*|[.,;:!?|]+"
#: Text bytes that one range of documents is meant to hold.
RANGE_BYTES = 256 << 20


def branches(text: Column) -> Column:
    """``array<array<array<string>>>``: digests of the pieces by section and paragraph."""
    pieces = lambda paragraph: F.transform(F.regexp_extract_all(paragraph, F.lit(PIECES), F.lit(0)), lambda p: F.sha2(p, 256))
    return F.transform(F.split(text, "\n\n", -1), lambda section: F.transform(F.split(section, "\n", -1), pieces))


def paragraph_digests(tree: Column) -> Column:
    """``array<array<string>>``: one digest per paragraph, by section."""
    return F.transform(tree, lambda section: F.transform(section, lambda pieces: F.sha2(F.concat(F.lit("p:"), F.array_join(pieces, "")), 256)))


def root_digest(paragraphs: Column) -> Column:
    sections = F.transform(paragraphs, lambda section: F.sha2(F.concat(F.lit("s:"), F.array_join(section, "")), 256))
    return F.sha2(F.concat(F.lit("r:"), F.array_join(sections, "")), 256)


def short_tree(tree: Column) -> Column:
    """Marks of all pieces: paragraphs after ``;``, sections after ``|``."""
    paragraph = lambda pieces: F.array_join(F.transform(pieces, lambda h: F.substring(h, 1, MARK)), "")
    return F.array_join(F.transform(tree, lambda section: F.array_join(F.transform(section, paragraph), ";")), "|")


def marks(tree: Column) -> Column:
    """The distinct marks of a text's pieces."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(tree)), lambda h: F.substring(h, 1, MARK)))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sets of marks, 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b)
    return F.when(whole == 0, F.lit(1.0)).otherwise(2.0 * both / whole)


def differing(a: Column, b: Column) -> Column:
    """The paragraphs of ``a`` (digests by section) that ``b`` has nowhere: array of (section, paragraph), from 0."""
    known = F.flatten(b)
    at = lambda section, i: F.filter(F.transform(section, lambda h, j: F.struct(i.alias("section"), j.alias("paragraph"), h.alias("digest"))), lambda x: ~F.array_contains(known, x["digest"]))
    return F.transform(F.flatten(F.transform(a, at)), lambda x: F.struct(x["section"], x["paragraph"]))


def with_fingerprint(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` with ``<prefix>tree``, ``<prefix>paragraphs``, ``<prefix>marks`` and ``<prefix>fingerprint`` of a column of texts."""
    tree, paragraphs = f"{prefix}tree", f"{prefix}paragraphs"
    df = df.withColumn(tree, branches(F.col(text)))
    df = df.withColumn(paragraphs, paragraph_digests(F.col(tree))).withColumn(f"{prefix}marks", marks(F.col(tree)))
    return df.withColumn(f"{prefix}fingerprint", F.concat_ws(":", root_digest(F.col(paragraphs)), short_tree(F.col(tree))))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``root``, ``fingerprint`` and ``paragraphs`` (digests by section).

    Null texts count as empty: one section with one empty paragraph.  Null ids stay, repeated rows repeat, an empty table
    gives an empty result; nothing is shuffled.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = with_fingerprint(frame, "text", "f_")
    return found.select(F.col("id").alias(id_col), F.substring_index("f_fingerprint", ":", 1).alias("root"), F.col("f_fingerprint").alias("fingerprint"), F.col("f_paragraphs").alias("paragraphs"))


def beside_next(frame: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``frame`` (id, text) with the columns of ``with_fingerprint`` (prefix ``f_``) and ``next``, a struct of ``text`` and ``marks`` of
    the following row by descending id; the last row is followed by the first.

    Rows go to ranges of ids, cut so that a range holds about ``range_bytes`` of text; each range also gets a copy of the
    first row of the range after it.  The texts are shuffled once.  Null ids come last; rows of one id are ordered by a
    hash of their texts, so that the rows of one id can be in several ranges.
    """
    order = ["unset", "down", "hash"]
    key = {"unset": F.col("id").isNull(), "down": F.bitwise_not("id"), "hash": F.xxhash64("text")}
    keys = stored(frame.select(*[c.alias(n) for n, c in key.items()], F.octet_length("text").cast("long").alias("bytes")), "keys")
    size = keys.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes))
    bucket = range_bucket_expr(keys, order, ranges)
    # one row per range: its first row follows the range before it, that of the first range follows the last
    whole = Window.orderBy("bucket")
    last = F.max("bucket").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = keys.groupBy(bucket.alias("bucket")).agg(F.min(F.struct(*order)).alias("k"))
    firsts = F.broadcast(firsts.select("k", F.coalesce(F.lag("bucket").over(whole), last).alias("before")))
    rows = frame.select(*[c.alias(n) for n, c in key.items()], "id", "text").withColumn("bucket", bucket)
    same = [F.col(c).eqNullSafe(F.col(f"k.{c}")) for c in order]
    copies = rows.join(firsts, same[0] & same[1] & same[2]).select(*order, "id", "text", F.col("before").alias("bucket"), F.lit(1).alias("copy"))
    dealt = rows.withColumn("copy", F.lit(0)).unionByName(copies).repartition("bucket")
    known = with_fingerprint(dealt, "text", "f_")
    following = F.lead(F.struct("text", F.col("f_marks").alias("marks"))).over(Window.partitionBy("bucket").orderBy("copy", *order))
    return known.withColumn("next", following).filter("copy = 0").drop(*order, "bucket", "copy")


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each text against itself with its last third replaced from the document that follows by descending id (the
    first one follows the last): the id, ``n_chars``, ``edited``, both fingerprints, ``near_edited``, ``near_next`` (likeness to the edited
    text and to the following one) and ``changed`` (the edited text's paragraphs that the text has nowhere, as (section, paragraph)).

    Null texts count as empty.  Null ids come last; a single row follows itself; repeated rows repeat; an empty table
    gives an empty result.  Further columns are not read.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    pairs = beside_next(frame, range_bytes).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next.text", F.lit(1), cut)))
    pairs = with_fingerprint(pairs.select("id", n.cast("long").alias("n_chars"), "edited", "f_fingerprint", "f_marks", "f_paragraphs", F.col("next.marks").alias("next_marks")), "edited", "e_")
    return pairs.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited",
        F.col("f_fingerprint").alias("fingerprint"),
        F.col("e_fingerprint").alias("edited_fingerprint"),
        likeness(F.col("f_marks"), F.col("e_marks")).alias("near_edited"),
        likeness(F.col("f_marks"), F.col("next_marks")).alias("near_next"),
        differing(F.col("e_paragraphs"), F.col("f_paragraphs")).alias("changed"),
    )
