"""Near-duplicate lines, found with an exact set-similarity join.

A line is the set of its words. The words of a set are ordered by rarity; if two sets
have Jaccard similarity t, their first few words (the prefix) have one in common. A pair
that shares a prefix word is dropped when the sizes, the places of that word or a 128-bit
map of the words show that the overlap cannot be large enough, and then when a map of
512 bits does. What is left is verified on the words. A line is removed if an earlier
line, removed or not, is that similar.

Lines with equal words in another order or number are different texts of equal sets. They
meet by a token of the whole set, so a line is cut into words only where its words count.

Rarity is counted in a fixed number of hash buckets, so the counts have a fixed size and
travel with the plan. Any order of words gives the same result; rare first is fast.
"""

from __future__ import annotations

from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BLANK_CHARACTERS, BLANKS, Scratch, read_table

SIMILARITY = 0.8
COUNT_BUCKETS = 1 << 15
#: Numbers of sets that are sent to all tasks at most, eight bytes each.
BROADCAST_ROWS = 2_000_000
#: Shares of the words that are joined one after the other.
PASSES = 2
#: 64-bit numbers of the wide map of the words of a set.
WIDE = 8
#: Codec of the tables that hold texts.
DENSE = "zstd"
#: Bits of a word's hash in its token, below the seven of its class.
HASH_BITS = 55
#: Order of lines. Structs compare nulls as smallest, so rows without an id come first.
PLACE = ["doc_id", "line", "entry"]


def line_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, line, entry, words): the lower-case words of each line, joined by spaces.
    ``rows`` (doc_id, text, entry).

    Only lines with other blanks than single spaces pass through the pattern."""
    lines = rows.select("doc_id", "entry", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    lower = lines.select(*PLACE, F.lower("body").alias("body"))
    odd = reduce(Column.__or__, [F.col("body").contains(blank) for blank in ["  ", *BLANK_CHARACTERS[1:]]])
    plain = F.trim(F.when(odd, F.regexp_replace("body", BLANKS, " ")).otherwise(F.col("body")))
    return lower.select(*PLACE, plain.alias("words"))


def numbered_sets(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(set, entry, line, words) of each different text of a line, with the place of its
    first line, written. The numbers ascend with the places. Equal texts are written as one
    before they are put in order, so that disk holds the words of one shuffle at a time.
    Lines without words are left out, by a sum so that no filter repeats the cleaning."""
    keyed = line_texts(rows).groupBy(F.xxhash64("words").alias("hash"), "words")  # sorted by the hash first
    firsts = keyed.agg(F.min(F.struct(*PLACE)).alias("first"), F.sum(F.length("words")).alias("long")).filter("long > 0")
    different = scratch.write(firsts.select("first.*", "words"), "different", codec=DENSE)
    ordered = different.orderBy(*PLACE).select(F.monotonically_increasing_id().alias("set"), "entry", "line", "words")
    sets = scratch.write(ordered, "sets", codec=DENSE)
    scratch.drop(different)
    return sets


def bit(number: Column) -> Column:
    """The bit of a 64-bit map that the last six bits of a number name."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def bucket_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(COUNT_BUCKETS)).cast("int")


def rarity_classes(sets: DataFrame) -> bytearray:
    """One byte a bucket, at most 127, larger for more frequent words; COUNT_BUCKETS bytes in all."""
    words = sets.select(F.explode(F.split("words", " ")).alias("word"))
    counts = words.groupBy(bucket_of(F.col("word")).alias("bucket")).count()
    classes = bytearray(COUNT_BUCKETS)
    for row in counts.collect():  # at most COUNT_BUCKETS rows
        classes[row["bucket"]] = min(127, int(4 * log2(row["count"] + 1)))
    return classes


def needed(size: Column, other: Column, similarity: float) -> Column:
    """Smallest overlap of two sets of that similarity."""
    return F.ceil((size + other) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))


def postings(sets: DataFrame, classes: bytearray, similarity: float) -> DataFrame:
    """(token, set, fit, low, high) for each prefix word of each set, and for the whole set, at
    place 0; fit: the size of the set and the place of the word in one number; low, high:
    a map of 128 bits, whether the words of the set that share a bit are odd in number.

    A token is the class of its word and 55 bits of a hash in one number, so that sorting
    tokens is sorting numbers. Words that share a token only add candidates.
    """

    def token(word: Column) -> Column:
        kind = F.ascii(F.substring(F.lit(classes), bucket_of(word) + 1, F.lit(1)).cast("string"))
        return F.shiftleft(kind.cast("long"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 64 - HASH_BITS))

    different = F.array_distinct(F.split("words", " "))
    ranked = sets.select("set", F.sort_array(F.transform(different, token)).alias("ranked"))
    none = F.lit(0).cast("long")
    high = lambda one: one.bitwiseAND(F.lit(64)) != 0
    odd = lambda own: F.aggregate(
        "ranked", none, lambda bits, one: F.when(own(one), bits.bitwiseXOR(bit(one))).otherwise(bits)
    )
    arranged = ranked.select(
        "set",
        "ranked",
        F.size("ranked").alias("size"),
        odd(lambda one: ~high(one)).alias("low"),
        odd(high).alias("high"),
    )
    prefix = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - F.lit(1e-9)).cast("int") + 1
    tokens = F.concat(F.array(F.xxhash64("ranked")), F.slice("ranked", F.lit(1), prefix))
    placed = arranged.select("set", "size", "low", "high", F.posexplode(tokens).alias("after", "token"))
    place = F.greatest(F.col("after") - 1, F.lit(0))
    fit = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(place.cast("long"))
    return placed.select("token", "set", fit.alias("fit"), "low", "high")


def met_postings(posted: DataFrame) -> DataFrame:
    """(token, set, size, place, low, high, head) of the tokens that two sets have; head: the
    posting of the earliest set with that token. Tokens of one set meet nothing, they are
    not written."""

    def parts(prefix: str = "") -> list[Column]:
        size = F.shiftright(F.col(f"{prefix}fit"), 32).cast("int").alias("size")
        place = F.col(f"{prefix}fit").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("place")
        return [size, place, *[F.col(f"{prefix}{name}").alias(name) for name in ("set", "low", "high")]]

    own = Window.partitionBy("token")
    head = F.min(F.struct("set", "fit", "low", "high")).over(own)
    met = posted.select("*", head.alias("head"), F.count("*").over(own).alias("times")).filter("times > 1")
    return met.select("token", *parts(), F.struct(*parts("head.")).alias("head"))


def most_apart(size: Column, other: Column, similarity: float) -> Column:
    """Largest number of words that only one of two sets of that similarity has."""
    return size + other - 2 * needed(size, other, similarity)


def may_match(a: str, b: str, similarity: float) -> Column:
    """Order, length, positional and map filter on the columns of two postings; b first."""
    col = lambda side, name: F.col(f"{side}.{name}")
    sizes = (F.least(col(a, "size"), col(b, "size")) + F.lit(1e-9)) >= F.greatest(
        col(a, "size"), col(b, "size")
    ) * F.lit(similarity)
    overlap = needed(col(a, "size"), col(b, "size"), similarity)
    rest = F.least(col(a, "size") - col(a, "place"), col(b, "size") - col(b, "place"))
    apart = sum(F.bit_count(col(a, half).bitwiseXOR(col(b, half))) for half in ("low", "high"))
    limit = most_apart(col(a, "size"), col(b, "size"), similarity)
    return (col(b, "set") < col(a, "set")) & sizes & (rest >= overlap) & (apart <= limit)


def chosen_sets(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(set, words) of the sets in some pairs. Words are moved only if the numbers of these
    sets are too many to be sent to all tasks."""
    both_sides = pairs.select("set").unionByName(pairs.select(F.col("to_set").alias("set")))
    wanted = scratch.write(both_sides.distinct(), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    return sets.select("set", "words").join(F.broadcast(wanted) if few else wanted, "set", "left_semi")


def wide_maps(sets: DataFrame) -> DataFrame:
    """(set, map_0, map_1...): the hashes of the words of each set, modulo 64 * WIDE, as bits."""
    hashes = sets.select("set", F.explode(F.split("words", " ")).alias("word")).select(
        "set", F.xxhash64("word").alias("hash")
    )
    own = F.pmod(F.shiftrightunsigned("hash", 6), F.lit(WIDE))
    part = lambda at: F.when(own == at, bit(F.col("hash"))).otherwise(F.lit(0).cast("long"))
    return hashes.groupBy("set").agg(*[F.bit_or(part(at)).alias(f"map_{at}") for at in range(WIDE)])


def near_by_maps(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(set, to_set) of the pairs (set, to_set, apart) whose wide maps differ in at most
    ``apart`` bits, written: every differing bit is a word that only one of them has."""
    maps = scratch.write(wide_maps(chosen_sets(pairs, sets, scratch)), "maps")
    earlier = maps.select(F.col("set").alias("to_set"), *[F.col(f"map_{at}").alias(f"to_map_{at}") for at in range(WIDE)])
    differing = sum(
        (F.bit_count(F.col(f"map_{at}").bitwiseXOR(F.col(f"to_map_{at}"))) for at in range(WIDE)), F.lit(0)
    )
    both = pairs.join(maps, "set").join(earlier, "to_set").filter(differing <= F.col("apart"))
    near = scratch.write(both.select("set", "to_set"), "near")
    scratch.drop(maps)
    return near


def verified(pairs: DataFrame, sets: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(set) of the later sets of pairs (set, to_set, apart) that are similar enough by
    their words, written. Only the words of sets in a pair of near maps are moved."""
    near = near_by_maps(pairs, sets, scratch)
    chosen = chosen_sets(near, sets, scratch)
    earlier = chosen.select(F.col("set").alias("to_set"), F.col("words").alias("to_words"))
    both = near.join(chosen, "set").join(earlier, "to_set")
    different = lambda words: F.array_distinct(F.split(words, " "))
    cut = both.select("set", different("words").alias("a"), different("to_words").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    similar = cut.filter(common + F.lit(1e-9) >= (F.size("a") + F.size("b") - common) * F.lit(similarity))
    found = scratch.write(similar.select("set").distinct(), "verified")
    scratch.drop(near)
    return found


def later_matches(sets: DataFrame, scratch: Scratch, similarity: float = SIMILARITY) -> DataFrame:
    """(set) of the sets that have an earlier similar set. ``sets``: different sets.

    First every set is compared with the earliest set of each of its prefix words. In a
    group of many near copies this decides nearly all, so only the few undecided sets
    meet all earlier sets that share a word, and not all pairs of the group are made.
    They meet in PASSES, each for its share of the words, so that disk holds the shuffle of
    one share at a time.
    """
    posted = postings(sets, rarity_classes(sets), similarity)
    met = scratch.write(met_postings(posted), "postings")
    apart = most_apart(F.col("a.size"), F.col("b.size"), similarity).cast("int").alias("apart")
    pair = ["a.set", F.col("b.set").alias("to_set"), apart]
    to_heads = met.select(F.struct("set", "size", "place", "low", "high").alias("a"), F.col("head").alias("b"))
    first_pairs = scratch.write(
        to_heads.filter(may_match("a", "b", similarity)).select(*pair).distinct(), "head-pairs"
    )
    decided = verified(first_pairs, sets, scratch, similarity)
    scratch.drop(first_pairs)

    bare = met.drop("head")
    open_ones = met.filter("set <> head.set").drop("head").join(decided, "set", "left_anti")
    passes = []
    for number in range(PASSES):
        own = F.pmod(F.col("token"), F.lit(PASSES)) == number
        to_all = open_ones.filter(own).alias("a").join(bare.filter(own).alias("b"), F.col("a.token") == F.col("b.token"))
        near = to_all.filter(may_match("a", "b", similarity)).select(*pair).distinct()
        passes.append(scratch.write(near, "pairs"))
    scratch.drop(met)
    pairs = scratch.write(reduce(DataFrame.unionByName, passes).distinct(), "all-pairs")
    scratch.drop(*passes)
    return decided.unionByName(verified(pairs, sets, scratch, similarity))


def kept_lines(rows: DataFrame, scratch: Scratch, similarity: float = SIMILARITY) -> DataFrame:
    """(entry, line) of the lines with words that stay."""
    sets = numbered_sets(rows, scratch)
    gone = later_matches(sets, scratch, similarity)
    return sets.join(gone, "set", "left_anti").select("entry", "line")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_lines, n_removed, clean_text) for every row of ``docs``.

    Lines end at line feeds and are compared as sets of lower-case words. A line is
    removed if an earlier line, by id and then line number, has at least the given
    Jaccard similarity; lines without words stay. Null text is the empty text, one line
    without words. Rows without an id come first. Equal line numbers of rows that share an
    id, or have none, are in the order in which the rows are read: the rows are written
    once with a number of their own.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = scratch.write(
        docs.select(
            "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("entry")
        ),
        "rows",
        codec=DENSE,
    )
    kept = scratch.write(
        kept_lines(rows, scratch, similarity).groupBy("entry").agg(F.collect_list("line").alias("kept")), "kept"
    )
    lines = F.split("text", "\n")
    blank = lambda line: F.trim(F.regexp_replace(line, BLANKS, " ")) == ""
    stay = F.filter(
        lines, lambda line, at: F.coalesce(F.array_contains("kept", at), F.lit(False)) | blank(line)
    )
    return rows.join(kept, "entry", "left").select("doc_id", F.size(lines).alias("n_lines"), stay.alias("stay")).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("stay")).cast("long").alias("n_removed"),
        F.array_join("stay", "\n").alias("clean_text"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents"))


EXPECTED = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line
  FROM documents
), sets AS (
  SELECT doc_id, line, body, list_sort(list_distinct(list_filter(
           string_split_regex(lower(body), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS words
  FROM lines
), firsts AS (
  SELECT words, len(words) AS size, min((doc_id, line)) AS place
  FROM sets WHERE len(words) > 0 GROUP BY words
), matched AS (
  SELECT DISTINCT a.place
  FROM firsts a JOIN firsts b ON b.place < a.place
   AND b.size >= 0.8 * a.size AND a.size >= 0.8 * b.size
  WHERE len(list_intersect(a.words, b.words))
        >= 0.8 * (a.size + b.size - len(list_intersect(a.words, b.words))) - 1e-9
), marked AS (
  SELECT s.doc_id, s.line, s.body,
         len(s.words) = 0 OR (f.place = (s.doc_id, s.line) AND m.place IS NULL) AS stays
  FROM sets s LEFT JOIN firsts f ON f.words = s.words LEFT JOIN matched m ON m.place = f.place
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       coalesce(string_agg(body, chr(10) ORDER BY line) FILTER (stays), '') AS clean_text
FROM marked GROUP BY doc_id
"""
