"""Document fingerprints: bottom-k sketches of shingle hashes, with built-in functions only.

A text's shingles are its runs of five words (parted by ASCII white space); all its words are one shingle, if
fewer. A shingle's hash is the first 64 bits of its MD5, which any other engine can compute. The sketch is the
``K`` smallest distinct hashes in ascending order, written as 16 hex digits each. A text of at most ``K``
shingles is kept whole, so its estimates are exact.

Sketches merge: the bottom k of two sketches' union is the sketch of both texts' shingles together. From them
come resemblance (share of the merged sketch found in both), containment, and the number of distinct shingles.
Everything about one text is computed in its own row; no shingle is shuffled.

Defined cases: a null text is empty; a text without words has the empty sketch; two empty sketches are alike
(1), an empty and another are not (0); a very long text is sketched whole; hashes that tie are one hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, id_key, written

K = 128
SHINGLE = 5
DIGITS = 16
FAN = 64


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return _bind(bare, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ASCII_SPACE)))


def sketch(text: Column, k: int = K, width: int = SHINGLE) -> Column:
    """The sketch of ``text`` as an ascending array of hashes."""
    # get() past the end is null, which concat_ws leaves out: fewer words than ``width`` are one shingle.
    one = lambda w, i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(width)])
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
    hashes = _bind(words(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(starts(w), lambda i: F.substring(F.md5(one(w, i)), 1, DIGITS))))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def to_string(sk: Column) -> Column:
    return F.array_join(sk, "")


def from_string(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f".{{{DIGITS}}}"), F.lit(0))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    shared = lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)
    return _bind(merged(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(shared(u)))


def distinct_shingles(sk: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else (k - 1) / the k-th hash as a fraction."""
    digits = 12  # 48 bits are exact in a double
    part = F.conv(F.substring(F.element_at(sk, -1), 1, digits), 16, 10).cast("double")
    return F.when(F.size(sk) < k, F.size(sk).cast("double")).otherwise(F.lit(k - 1.0) / ((part + 1) / F.lit(16.0 ** digits)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that are in ``b``, 0 to 1; an empty ``a`` is contained in anything."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def merge_groups(rows: DataFrame, by: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per group of ``rows``: that of all its parts' shingles together.

    Equal sketches count once; the others are dealt by hash into salts of about ``FAN`` sketches and merged there,
    again and again, until a group has one: no task holds more than a salt's sketches, however large a group is."""
    keys = [F.col(c).alias(f"_tf_g{i}") for i, c in enumerate(by)]
    names = [f"_tf_g{i}" for i in range(len(by))]
    parts = written(rows.select(*keys, F.col(sketch_col).alias("_tf_s")).filter("_tf_s is not null").distinct(), "fingerprint-parts")
    while True:
        largest = parts.groupBy(*names).count().agg(F.max("count")).first()[0] or 0
        salt = F.pmod(F.xxhash64("_tf_s"), F.lit(-(-largest // FAN) if largest > FAN else 1))
        joined = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_tf_s")))), 1, k)
        parts = written(parts.groupBy(*names, salt.alias("_tf_salt")).agg(joined.alias("_tf_s")).drop("_tf_salt").distinct(), "fingerprint-parts")
        if largest <= FAN:
            return parts.select(*[F.col(n).alias(c) for n, c in zip(names, by)], F.col("_tf_s").alias(sketch_col))


# ---------------------------------------------------------------- documents and their successors


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k: key of an id, next: key of the next id in ascending order, the first after the last; null is the
    lowest id; tail: a quarter of the id's longest text). Ids alone are sorted: by ranges, numbered inside their
    partition, and offset by the partitions' counts; no window spans the table."""
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.max(F.floor(F.length(F.coalesce(F.col(text_col), F.lit(""))) / 4)).cast("int").alias("tail"))
    first = F.col("id").asc_nulls_first()
    pos = F.monotonically_increasing_id()
    ids = written(ids.repartitionByRange(first).sortWithinPartitions(first).select(id_key(F.col("id")).alias("k"), "tail", pos.alias("pos")), "fingerprint-ids")
    parts = ids.groupBy(F.shiftright("pos", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.col("start") + F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    ids = written(ids.join(starts, F.shiftright("pos", 33) == F.col("part")).select("k", "tail", at.alias("at")), "fingerprint-order")
    n = ids.count()
    after = ids.select(F.col("k").alias("next"), F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"))
    return written(ids.join(after, "at").select("k", "next", "tail"), "fingerprint-next")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter replaced by the start of the next document's text. Rows repeating an id
    share the next id; of rows repeating that next id, the one whose needed start (then whose sketch) is least
    counts. Only those starts and the sketches travel to the predecessor; whole texts are shuffled once, by id
    (both joins read the same exchange), and a hot id's rows can be split. A table of one id follows itself."""
    follow = successors(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("_tf_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_tf_text"), id_key(F.col(id_col)).alias("_tf_k"))
    sent = rows.join(follow, F.col("_tf_k") == F.col("next")).select(
        F.col("k"), F.struct(F.substring("_tf_text", F.lit(1), F.col("tail")).alias("start"), F.unhex(to_string(sketch(F.col("_tf_text"), k))).alias("sketch"),
                             F.col("_tf_id").alias("id")).alias("s"))
    sent = sent.groupBy("k").agg(F.min("s").alias("s"))
    both = rows.join(sent, F.col("_tf_k") == F.col("k"))
    n, q = F.length("_tf_text"), F.floor(F.length("_tf_text") / 4).cast("int")
    edited = F.concat(F.substring("_tf_text", F.lit(1), n - q), F.substring(F.col("s.start"), F.lit(1), q))
    both = both.select(F.col("_tf_id"), n.cast("long").alias("n"), "_tf_text", edited.alias("edited"), F.lower(F.hex("s.sketch")).alias("next_print"))
    both = both.select("_tf_id", "n", F.sha2("edited", 256).alias("digest"), sketch(F.col("_tf_text"), k).alias("own"),
                       sketch(F.col("edited"), k).alias("other"), from_string(F.col("next_print")).alias("next"))
    return both.select(F.col("_tf_id").alias(id_col), F.col("n").alias("n_chars"), F.col("digest").alias("edited_sha256"),
                       to_string(F.col("own")).alias("fingerprint"), to_string(F.col("other")).alias("edited_fingerprint"),
                       resemblance(F.col("own"), F.col("other"), k).alias("near_edited"),
                       resemblance(F.col("own"), F.col("next"), k).alias("near_next"))
