"""Document fingerprints from chains of content words after common words.

Common words are anchors. Each anchor opens a chain: the anchor and the next content
words after it, other anchors left out. The set of all chains of a text is its
fingerprint; boilerplate without common words adds nothing to it. Two fingerprints are
compared by Jaccard similarity of the sets. In the search for near duplicates sets are
partitioned by size, because sets of very different sizes cannot be similar.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, read_table
from tidelog.llm.components import connected_components

#: Common words of the four languages of the corpus.
ANCHORS = [
    "the", "of", "and", "to", "in", "is", "was", "that", "for", "with", "on", "are",
    "der", "die", "das", "und", "ist", "von", "den", "mit", "zu", "ein",
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "qui", "pour",
    "el", "los", "las", "y", "por", "con", "una", "del",
]
CHAIN = 3
SIMILARITY = 0.8


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Different chains of a text in order; words are runs of letters and digits.

    The chain of an anchor at the end is as long as content words are left; without any
    there is no chain. A text with words but without a chain is one chain itself, so that
    such texts are alike only when their words are the same.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))

    def made(one: Column) -> Column:
        whole = lambda found: F.when((F.size(found) == 0) & (one != ""), F.array(one)).otherwise(found)
        return F.transform(F.array(_chains(F.split(one, " "), chain)), whole)[0]

    return F.transform(F.array(plain), made)[0]


def _chains(words: Column, chain: int) -> Column:
    """Chains of a list of words. Of the anchor with number j at place p, p - j content
    words come before, so its chain is a slice of the content words."""
    is_anchor = lambda word: word.isin(ANCHORS)
    content = F.filter(words, lambda word: ~is_anchor(word))
    marked = F.transform(words, lambda word, at: F.when(is_anchor(word), at))
    places = F.filter(marked, lambda at: at.isNotNull())

    def made(both: Column) -> Column:
        found = F.transform(
            both["places"],
            lambda place, number: F.concat_ws(
                " ",
                F.array(F.element_at(both["words"], place + 1)),
                F.slice(both["content"], place - number + 1, F.lit(chain)),
            ),
        )
        long_enough = F.filter(found, lambda one: F.contains(one, F.lit(" ")))
        return F.array_sort(F.array_distinct(long_enough))

    parts = F.struct(words.alias("words"), content.alias("content"), places.alias("places"))
    return F.transform(F.array(parts), made)[0]


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of chains; two empty sets are alike."""
    common = F.size(F.array_intersect(a, b))
    together = F.size(a) + F.size(b) - common
    return F.when(together == 0, F.lit(1.0)).otherwise(common / together)


def printed(chains: Column) -> Column:
    """A set of chains as a short text, equal for equal sets."""
    return F.md5(F.array_join(chains, "\n"))


def with_next_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): the next text in descending order of ids, after the
    last the first.

    Rows are dealt by ranges of ids, as many as shuffle partitions, rows of one id to one
    range. Within a range the next row is the neighbour. The first row of every range is
    dealt once more, to the end of the range before it, so that nothing but one shuffle
    holds texts. Rows without an id come last; rows that repeat an id are ordered by text.
    """
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [part / parts for part in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] or []
    bounds = F.lit(sorted(set(cuts))) if cuts else F.array().cast("array<bigint>")
    above = F.size(F.filter(bounds, lambda bound: bound >= F.col("doc_id")))
    own = F.when(F.col("doc_id").isNull(), F.lit(parts)).otherwise(above)
    ranged = rows.withColumn("range", own.cast("int"))

    first_ids = ranged.groupBy("range").agg(F.max("doc_id").alias("first_id"))  # a row for each range
    is_first = (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    heads = (
        ranged.join(F.broadcast(first_ids.withColumnRenamed("range", "at")), is_first)
        .groupBy("range", "doc_id")
        .agg(F.max("text").alias("text"))
    )
    before = F.lag("range").over(Window.orderBy("range"))
    ends = heads.select("doc_id", "text", F.coalesce(before, F.max("range").over(Window.partitionBy())).alias("range"))
    dealt = (
        ranged.withColumn("added", F.lit(False))
        .unionByName(ends.withColumn("added", F.lit(True)))
        .repartitionById(parts + 1, F.col("range"))
    )
    inside = Window.partitionBy("range").orderBy("added", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    return (
        dealt.withColumn("next_text", F.lead("text").over(inside))
        .filter(~F.col("added"))
        .select("doc_id", "text", "next_text")
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many, or all, of the next text. Result: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null is the empty text, which has no
    chains; texts without words are alike. A single row is its own next row.
    """
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    rows = with_next_text(docs).select(
        "doc_id", "text", "next_text", size.cast("long").alias("n_chars"), edited.alias("edited")
    )
    sets = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"),
        signatures(F.col("edited")).alias("changed"),
        signatures(F.col("next_text")).alias("following"),
    )
    return sets.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def near_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, fingerprint, component_id): groups of rows with similar fingerprints.

    Sets are dealt into bands of sizes, each as wide as similar sets can differ, so a set
    meets only sets of its own and the next larger band. Within a band sets are joined on
    the first chains in hash order: of similar sets, the prefixes share a chain. Pairs
    whose sizes or prefix places rule out the similarity are pruned before the sets are
    compared. Equal sets are one set; texts without words form one group.
    """
    scratch = Scratch(docs.sparkSession, "spot-groups")
    rows = scratch.write(
        docs.select("doc_id", F.transform(signatures(F.col("text")), lambda one: F.xxhash64(one)).alias("chains")).select(
            "doc_id", F.array_sort(F.array_distinct("chains")).alias("chains")
        ),
        "rows",
    )
    printed_set = F.xxhash64("chains")
    sets = scratch.write(
        rows.groupBy("chains").agg(F.min("doc_id").alias("first_id")).select(
            printed_set.alias("node"), "chains", "first_id", F.size("chains").alias("size")
        ),
        "sets",
    )
    band = F.floor(F.log(F.greatest("size", F.lit(1))) / F.lit(log(1 / similarity))).cast("int")
    prefix = F.slice("chains", F.lit(1), F.greatest(F.lit(0), F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - 1e-9).cast("int") + 1))
    posted = sets.select("node", "size", band.alias("band"), F.posexplode(prefix).alias("place", "chain"))
    other = posted.select(
        F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"), "chain",
        F.col("node").alias("to_node"), F.col("size").alias("to_size"), F.col("place").alias("to_place"),
    )
    overlap = F.ceil((F.col("size") + F.col("to_size")) * F.lit(similarity / (1 + similarity)) - 1e-9)
    rest = F.least(F.col("size") - F.col("place"), F.col("to_size") - F.col("to_place"))
    pairs = (
        posted.join(other, ["band", "chain"])
        .filter((F.col("node") != F.col("to_node")) & (F.col("size") <= F.col("to_size")))
        .filter((F.col("size") + 1e-9 >= F.col("to_size") * F.lit(similarity)) & (rest >= overlap))
        .select("node", "to_node")
        .distinct()
    )
    own = sets.select("node", F.col("chains").alias("own"))
    theirs = sets.select(F.col("node").alias("to_node"), F.col("chains").alias("theirs"))
    edges = scratch.write(
        pairs.join(own, "node")
        .join(theirs, "to_node")
        .filter(likeness(F.col("own"), F.col("theirs")) + 1e-9 >= similarity)
        .select(F.col("node").alias("a"), F.col("to_node").alias("b")),
        "links",
    )
    roots = connected_components(edges, scratch)
    members = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = members.join(ids, "root").select("node", "component_id")
    return rows.withColumn("node", printed_set).join(found, "node").select(
        "doc_id", F.lower(F.hex("node")).alias("fingerprint"), "component_id"
    )


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(read_table(spark, sf_dir, "documents"))


_LIST = ", ".join(f"'{word}'" for word in ANCHORS)
EXPECTED = f"""
WITH plain AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
following AS (
  SELECT doc_id, text, coalesce(
    lead(text) OVER (ORDER BY doc_id DESC NULLS LAST, text DESC),
    first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST, text DESC)) AS next_text
  FROM plain
), edits AS (
  SELECT doc_id, length(text) AS n_chars, text, next_text,
         left(text, (length(text) - length(text) // 2)::INT)
         || left(next_text, (length(text) // 2)::INT) AS edited
  FROM following
), words AS (
  SELECT *, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w0,
         string_split(trim(regexp_replace(lower(edited), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w1,
         string_split(trim(regexp_replace(lower(next_text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w2
  FROM edits
), parts AS (
  SELECT *, {", ".join(
    f"list_filter(w{n}, lambda w: w NOT IN ({_LIST})) AS c{n}, "
    f"list_filter(generate_series(1, len(w{n})), lambda i: w{n}[i] IN ({_LIST})) AS p{n}" for n in range(3))}
  FROM words
), found AS (
  SELECT *, {", ".join(
    f"list_sort(list_distinct(list_filter(list_transform(generate_series(1, len(p{n})), "
    f"lambda j: array_to_string(list_prepend(w{n}[p{n}[j]], c{n}[p{n}[j] - j + 1 : p{n}[j] - j + {CHAIN}]), ' ')), "
    f"lambda one: contains(one, ' ')))) AS t{n}" for n in range(3))}
  FROM parts
), sets AS (
  SELECT *, {", ".join(
    f"CASE WHEN len(t{n}) = 0 AND w{n} <> [''] THEN [array_to_string(w{n}, ' ')] ELSE t{n} END AS s{n}" for n in range(3))}
  FROM found
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
       md5(array_to_string(s0, chr(10))) AS fingerprint,
       md5(array_to_string(s1, chr(10))) AS edited_fingerprint,
       {", ".join(
    f"CASE WHEN len(s0) + len(s{n}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(s0, s{n}))::DOUBLE / "
    f"(len(s0) + len(s{n}) - len(list_intersect(s0, s{n}))) END AS {name}"
    for n, name in ((1, 'near_edited'), (2, 'near_next')))}
FROM sets
"""
