"""Document fingerprints by Order MinHash, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging

KMER_WORDS = 3
BUCKETS = 64
TUPLE = 2
# A packed entry: bucket and hash above, the place in the text below.
PLACE_BITS = 28
HASH_BITS = 29
BUCKET_BITS = 6
CUT_PARTS = 3
# Characters a row counts for besides its text, for its fingerprint.
ROW_CHARS = 400
NULL_KEY = "cast(-10000000000000000000 as decimal(20,0))"
WORD = r"[ \t-\r]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kmers(text: Column) -> Column:
    """Hashes of the word k-mers of a text, in order; fewer words make one k-mer."""
    words = F.filter(F.split(text, WORD), lambda w: w != "")

    def hashed(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, KMER_WORDS))))
        size = F.size(w)
        return F.slice(each, 1, F.when(size >= KMER_WORDS, size - KMER_WORDS + 1).otherwise(F.least(size, F.lit(1))))

    return _let(words, hashed)


def _numbered(hashes: Column) -> Column:
    """Packed (bucket, hash, place) of each occurrence-numbered k-mer, ascending.

    K-mers are sorted by hash and place; within a run of equal ones the place in the
    run is the occurrence number.
    """
    place = (1 << PLACE_BITS) - 1

    def packed(h: Column) -> Column:
        return F.array_sort(
            F.transform(
                h, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, PLACE_BITS + 1), PLACE_BITS).bitwiseOR(i.cast("long"))
            )
        )

    def occurrences(s: Column) -> Column:
        n = F.size(s)
        same = lambda i: F.shiftright(F.get(s, i), PLACE_BITS) == F.shiftright(F.get(s, i - 1), PLACE_BITS)
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(at, lambda i: (i == 0) | ~same(i))
        runs = _let(
            starts,
            lambda r: F.flatten(
                F.transform(r, lambda x, j: F.sequence(F.lit(0), F.coalesce(F.get(r, j + 1), n) - x - 1))
            ),
        )
        top = BUCKET_BITS + HASH_BITS
        return F.array_sort(
            F.zip_with(
                s,
                runs,
                lambda x, o: F.shiftleft(
                    F.shiftrightunsigned(F.xxhash64(F.shiftright(x, PLACE_BITS), o), 64 - top), PLACE_BITS
                ).bitwiseOR(x.bitwiseAND(F.lit(place).cast("long"))),
            )
        )

    return _let(_let(hashes, packed), occurrences)


def fingerprint(text: Column) -> Column:
    """The sketch of a text: ``bucket`` (2 hex) and ``tuple hash`` (4 hex) of each bucket, ascending.

    Each occurrence-numbered k-mer falls into one of 64 buckets; a bucket keeps its two
    smallest in the order of the text, and hashes them. A text without words has none.
    """

    def signed(e: Column) -> Column:
        bucket = lambda x: F.shiftright(x, PLACE_BITS + HASH_BITS)
        least = F.filter(e, lambda x, i: (i < TUPLE) | (bucket(F.get(e, i - TUPLE)) != bucket(x)))
        return _let(
            least,
            lambda m: F.filter(
                F.transform(
                    m,
                    lambda x, i: F.when(
                        (i == 0) | (bucket(F.get(m, i - 1)) != bucket(x)),
                        F.concat(
                            F.lower(F.lpad(F.hex(bucket(x)), 2, "0")), _tuple_hash(x, F.get(m, i + 1), bucket)
                        ),
                    ),
                ),
                lambda s: s.isNotNull(),
            ),
        )

    return _let(_numbered(kmers(F.coalesce(text, F.lit("")))), signed)


def _tuple_hash(first: Column, second: Column, bucket: Callable[[Column], Column]) -> Column:
    """Four hex digits of a bucket's two k-mers in the order of the text, or of its only one."""
    place = F.lit((1 << PLACE_BITS) - 1).cast("long")
    identity = lambda x: F.shiftright(x, PLACE_BITS)
    alone = second.isNull() | (bucket(first) != bucket(second))
    ordered = F.when(alone, F.xxhash64(identity(first))).otherwise(
        F.when(
            first.bitwiseAND(place) < second.bitwiseAND(place), F.xxhash64(identity(first), identity(second))
        ).otherwise(F.xxhash64(identity(second), identity(first)))
    )
    return F.lower(F.lpad(F.hex(ordered.bitwiseAND(F.lit(0xFFFF).cast("long"))), 4, "0"))


def entries(name: str) -> Column:
    """The entries of a joined fingerprint."""
    return F.regexp_extract_all(F.col(name), F.lit("(.{6})"), F.lit(1))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among buckets that either sketch has; 1 for two without words."""
    buckets = lambda x: F.transform(x, lambda s: F.substring(s, 1, 2))

    def share(x: Column, y: Column) -> Column:
        either = F.size(F.array_union(buckets(x), buckets(y)))
        return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / either)

    return _let(a, lambda x: _let(b, lambda y: share(x, y)))


def _neighbours(keyed: DataFrame, stage: Staging) -> DataFrame:
    """(key, longest, pick, parts, next_key): the next smaller key; the largest after the smallest.

    Keys are dealt to ranges, ordered within them, and the gaps between ranges closed by
    a table of one row a range; no task sees all keys. A key of several rows that hold
    more than a partition's share of all text is to be dealt in ``parts``.
    """
    length = F.char_length("text")
    keys = keyed.groupBy("key").agg(
        F.max(length).alias("longest"),
        F.min(F.xxhash64("text")).alias("pick"),
        F.count("*").alias("rows"),
        F.sum(length + ROW_CHARS).alias("chars"),
    )
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(partitions, F.desc("key")).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    share = max(1, (ranged.agg(F.sum("chars")).first()[0] or 0) // partitions)
    parts = F.when(F.col("rows") > 1, F.ceil(F.col("chars") / share)).otherwise(1).cast("int")
    firsts = ranged.groupBy("part").agg(F.max("key").alias("first_key"))
    following = firsts.select(
        "part",
        F.expr(
            "coalesce(lead(first_key) over (order by part), first_value(first_key) over (order by part))"
        ).alias("first_after"),
    )
    inside = F.expr("lead(key) over (partition by part order by key desc)")
    return (
        ranged.withColumn("inside", inside)
        .join(following, "part")
        .select(
            "key", "longest", "pick", parts.alias("parts"), F.coalesce("inside", "first_after").alias("next_key")
        )
    )


def _salts(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1)).alias("salt")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of an edited text, with their likeness.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text ends, instead of its last third of code
    points, with as many first ones of the next document (descending id, nulls last,
    the first after the last).

    Texts travel twice at most: whole, by their id, and cut to what the edit takes, by
    the id before. Null texts are empty. Rows of one id stand one after another's place
    together: the next document is that of the next different id, and where it has
    several rows, the one whose text hashes lowest. With a single id a document
    follows itself. An id with more text than a partition's share, such as null, is
    dealt in parts by row; what its rows need of the next document goes to each part. Other columns do not matter; an empty table gives an empty result.
    A place has 28 bits: k-mers beyond 268 million share places, not an error.
    """
    stage = Staging(docs.sparkSession)
    # A null id is the smallest key.
    key = F.coalesce(F.col(id_col).cast("long").cast("decimal(20,0)"), F.expr(NULL_KEY))
    own = docs.select(key.alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = stage(_neighbours(own, stage), "order")
    # No more keys than partitions hold more than a partition's share.
    hot = F.broadcast(order.where("parts > 1").select("key", "parts"))
    salt = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1))).cast("int")
    # Signed before the exchange that both uses below share.
    signed = own.join(hot, "key", "left").select(
        "key", salt.alias("salt"), "text", F.array_join(fingerprint(F.col("text")), "").alias("fingerprint")
    )

    before = order.select(
        F.col("next_key").alias("key"), F.col("key").alias("before_key"), "longest", F.col("parts").alias("before_parts")
    )
    before = before.join(order.select("key", "pick", "parts"), "key").select("*", _salts("parts"))
    following = (
        signed.join(before, ["key", "salt"])
        # Not an equality of two sides, which would deal the texts anew by it.
        .where(F.xxhash64("text").bitwiseXOR(F.col("pick")) == 0)
        .select(
            F.col("before_key").alias("key"),
            _salts("before_parts"),
            F.expr(f"left(text, cast(longest div {CUT_PARTS} as int))").alias("start"),
            F.col("fingerprint").alias("next_fingerprint"),
        )
        .groupBy("key", "salt")
        .agg(F.first("start").alias("start"), F.first("next_fingerprint").alias("next_fingerprint"))
    )
    edited = signed.join(following, ["key", "salt"]).withColumn("n_chars", F.char_length("text"))
    edited = edited.select(
        "key",
        "n_chars",
        "fingerprint",
        "next_fingerprint",
        F.expr(
            f"concat(left(text, cast(n_chars - n_chars div {CUT_PARTS} as int)), "
            f"left(start, cast(n_chars div {CUT_PARTS} as int)))"
        ).alias("edited"),
    )
    edited = edited.select(
        "*", F.sha2("edited", 256).alias("edited_sha256"), F.array_join(fingerprint(F.col("edited")), "").alias("other")
    )
    return edited.select(
        F.when(F.col("key") != F.expr(NULL_KEY), F.col("key").cast("long")).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        "fingerprint",
        F.col("other").alias("edited_fingerprint"),
        likeness(entries("fingerprint"), entries("other")).alias("near_edited"),
        likeness(entries("fingerprint"), entries("next_fingerprint")).alias("near_next"),
    )
