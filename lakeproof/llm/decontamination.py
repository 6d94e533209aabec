"""Benchmark passages in training text, by a distributed positional inverted index.

Texts are split once. Every occurrence of a term that a test window has becomes a posting (term,
document, position), and every document's end one more, which tells its length. The posting lists
of a window are intersected from its rarest term on: offsets turn postings of different terms into
places where the window would begin, and lists of the next rarest terms thin out what is left, before
the common ones are looked up for the few candidates alone. What has all terms in their places is
an exact phrase; what has all of them within a window's reach of the rarest one is a match in
proximity.

Everything is DataFrame operators; nothing runs in Python, and no text is shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.functions.naming import field, unique_names
from lakeproof.llm.support import sized_join, staged

# Fixed value: a word is letters a-z, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
#: The term of a document's end; no word is empty.
END = ""
#: How many of a window's rarest terms thin out its candidates list by list.
THINNING = 3
#: Words of a stretch of text by which postings that are near each other meet.
BUCKET = 16


def words_of(text: str | Column) -> Column:
    """The words of a text in order; null has none."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def test_windows(benchmark: DataFrame, length: int = WINDOW_WORDS) -> DataFrame:
    """(window, items): every distinct run of ``length`` words with the items that have it; a shorter item is one window.

    Items without words have none. A null item_id names no item, its windows count all the same.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of("text").alias("words"))
    width = F.least(F.size("words"), F.lit(length))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    return items.where(F.size("words") > 0).withColumn("start", F.explode(starts)).select(
        "item", F.slice("words", F.col("start"), width).alias("window")
    ).groupBy("window").agg(F.collect_set("item").alias("items"))


def postings(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, row, doc_id, version, position): where the given terms are, and every document's end as term ``END``.

    ``row`` is a number of the document's row, so that repeated ids stay apart; ``version`` is a hash of
    the text. Written to the shared folder: it is the index.
    """
    texts = documents.select("doc_id", F.xxhash64("text").alias("version"), words_of("text").alias("words")).withColumn("row", F.monotonically_increasing_id())
    marked = terms.select("term").unionByName(terms.sparkSession.range(1).select(F.lit(END).alias("term"))).distinct()
    each = texts.select("row", "doc_id", "version", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("position", "term"))
    return staged(sized_join(each, marked, "term").select("term", "row", "doc_id", "version", "position"), "postings")


def ordered_terms(windows: DataFrame, index: DataFrame) -> DataFrame:
    """(window, items, width, term, offset, rank): every window's terms from the rarest one on.

    A window with a term that no training text has can't occur and is left out.
    """
    frequencies = index.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("frequency"))
    terms = windows.select("window", "items", F.size("window").alias("width"), F.posexplode("window").alias("offset", "term")).join(frequencies, "term")
    whole = Window.partitionBy("window")
    return terms.withColumn("known", F.count("*").over(whole)).where("known = width").withColumn(
        "rank", F.row_number().over(whole.orderBy("frequency", "term", "offset"))
    ).select(F.xxhash64("window").alias("window_id"), "window", "items", "width", "term", "offset", "rank")


def _buckets(place: Column, reach: int) -> Column:
    """The stretches of text that hold whatever is within reach of a place."""
    low, high = (F.floor((place + F.lit(shift)) / BUCKET).cast("int") for shift in (-reach, reach))
    return F.sequence(low, high)


def intersect(index: DataFrame, terms: DataFrame, reach: int = WINDOW_WORDS - 1) -> DataFrame:
    """(window_id, row, place, start, width, exact): where a window's rarest term has all others within ``reach``.

    ``place`` is the rarest term's position and ``start`` that of the window it would belong to;
    ``exact`` says whether all terms stand where that window has them.
    """
    plan = staged(terms.select("window_id", "width", "term", "offset", "rank"), "window-terms")
    lists = index.where(F.col("term") != END).select("term", "row", "position")

    def of_rank(rank: int) -> DataFrame:
        named = plan.where(F.col("rank") == rank).select("term", F.col("window_id"), "width", "offset")
        return sized_join(lists, named, "term").select("window_id", "width", "row", "position", (F.col("position") - F.col("offset")).alias("start"))

    found = of_rank(1).select("window_id", "width", "row", F.col("position").alias("place"), "start", F.lit(True).alias("exact"))
    for rank in range(2, THINNING + 1):
        other = of_rank(rank).select(
            "window_id", "row", "position", F.col("start").alias("other_start"), F.floor(F.col("position") / BUCKET).cast("int").alias("bucket")
        )
        spread = found.withColumn("bucket", F.explode(_buckets(F.col("place"), reach)))
        near = F.abs(F.col("position") - F.col("place")) <= reach
        found = spread.join(other, ["window_id", "row", "bucket"], "left").groupBy("window_id", "width", "row", "place", "start", "exact").agg(
            F.count_if(near).alias("near"), F.coalesce(F.max(near & (F.col("other_start") == F.col("start"))), F.lit(False)).alias("there")
        ).where((F.col("near") > 0) | (F.col("width") < rank)).select(
            "window_id", "width", "row", "place", "start", (F.col("exact") & (F.col("there") | (F.col("width") < rank))).alias("exact")
        )
    found = staged(found, "window-candidates")
    # the common terms are looked up in the documents that are left, by the window's places alone
    left = sized_join(lists, found.select("row").distinct(), "row", "left_semi").withColumn("bucket", F.floor(F.col("position") / BUCKET).cast("int"))
    wanted = sized_join(found, plan.where(F.col("rank") > THINNING).select("window_id", "term", "offset", "rank"), "window_id").withColumn(
        "bucket", F.explode(_buckets(F.col("place"), reach))
    )
    near, there = F.abs(F.col("position") - F.col("place")) <= reach, F.col("position") == F.col("start") + F.col("offset")
    rest = wanted.join(left, ["row", "term", "bucket"]).groupBy("window_id", "width", "row", "place", "start", "exact").agg(
        F.count_distinct(F.when(near, F.col("rank"))).alias("near"), F.count_distinct(F.when(there, F.col("rank"))).alias("there")
    ).where(F.col("near") == F.col("width") - THINNING).select(
        "window_id", "row", "place", "start", "width", (F.col("exact") & (F.col("there") == F.col("width") - THINNING)).alias("exact")
    )
    return rest.unionByName(found.where(F.col("width") <= THINNING).select("window_id", "row", "place", "start", "width", "exact"))


def _covered(matches: str) -> Column:
    """How many words lie in any of some (start, width) matches."""
    zero = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("reach"))

    def step(done: Column, match: Column) -> Column:
        end = match["start"] + match["width"]
        fresh = F.greatest(F.lit(0), end - F.greatest(done["reach"], match["start"]))
        return F.struct((done["covered"] + fresh).alias("covered"), F.greatest(done["reach"], end).alias("reach"))

    return F.aggregate(F.array_sort(matches), zero, step, lambda done: done["covered"]).cast("bigint")


def contamination_by_version(documents: DataFrame, benchmark: DataFrame, length: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, version, n_words, n_hit, n_items, items_sha256, contaminated, n_near) of every row of the documents.

    ``n_near`` counts the matches in proximity, exact ones among them. Null text has no words. Repeated
    rows have a result each; rows with the same id and different texts are apart. Without test items
    nothing is hit. Other columns are not read.
    """
    windows = staged(test_windows(benchmark, length), "test-windows")
    index = postings(documents, windows.select(F.explode("window").alias("term")).distinct())
    terms = staged(ordered_terms(windows, index), "test-terms")
    matches = staged(intersect(index, terms, length - 1), "window-matches")
    named = sized_join(matches.where("exact"), terms.where("rank = 1").select("window_id", "items"), "window_id")
    hits = named.groupBy("row").agg(
        F.collect_set(F.struct("start", "width")).alias("matches"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).select("row", _covered("matches").alias("n_hit"), "items")
    near = matches.groupBy("row").agg(F.count("*").alias("n_near"))
    ends = index.where(F.col("term") == END).select("row", "doc_id", "version", F.col("position").cast("bigint").alias("n_words"))
    none = F.lit(0).cast("bigint")
    n_hit, items = F.coalesce("n_hit", none), F.coalesce("items", F.array().cast("array<string>"))
    return ends.join(hits, "row", "left").join(near, "row", "left").select(
        "doc_id", "version", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.coalesce("n_near", none).alias("n_near"),
    )


def find_contamination(documents: DataFrame, benchmark: DataFrame, length: int = WINDOW_WORDS) -> DataFrame:
    """``contamination_by_version`` without the version."""
    return contamination_by_version(documents, benchmark, length).drop("version")


def without_contaminated(documents: DataFrame, benchmark: DataFrame, length: int = WINDOW_WORDS) -> DataFrame:
    """The rows without a passage of the benchmark, with all their columns. Null texts and null ids are judged like others."""
    id_name, text_name = unique_names([*documents.columns, "hit_id", "hit_version"])[-2:]
    id_key, text_key = F.coalesce("doc_id", F.lit(-(1 << 63))), F.xxhash64("text")
    hit = contamination_by_version(documents, benchmark, length).where("contaminated").select(
        id_key.alias(id_name), F.col("version").alias(text_name)
    ).distinct()
    keyed = documents.withColumns({id_name: id_key, text_name: text_key})
    return sized_join(keyed, hit, [id_name, text_name], "left_anti").select(*[field(c) for c in documents.columns])


CONTAMINATION_SQL = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS words
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS words
  FROM benchmark
), windows AS (
  SELECT item, least(len(words), {WINDOW_WORDS}) AS width, words[p:p + least(len(words), {WINDOW_WORDS}) - 1] AS win
  FROM items, unnest(range(1, len(words) - least(len(words), {WINDOW_WORDS}) + 2)) AS starts(p)
  WHERE len(words) > 0
), places AS (
  SELECT doc_id, p, width, words[p:p + width - 1] AS win
  FROM texts, (SELECT DISTINCT width FROM windows) AS widths, unnest(range(1, len(words) - width + 2)) AS starts(p)
), hits AS (
  SELECT doc_id, p, width, item FROM places JOIN windows USING (width, win)
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + width)) AS inside(q) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
), terms AS (
  SELECT term, count(*) AS frequency FROM (SELECT unnest(words) AS term FROM texts) GROUP BY term
), rarest AS (
  SELECT win, arg_min(term, {{'frequency': frequency, 'term': term, 'p': p}}) AS term
  FROM (SELECT DISTINCT win, unnest(win) AS term, generate_subscripts(win, 1) AS p FROM windows) JOIN terms USING (term) GROUP BY win
), close AS (
  SELECT doc_id, count(*) AS n_near
  FROM (SELECT doc_id, words, unnest(words) AS term, generate_subscripts(words, 1) AS p FROM texts) JOIN rarest USING (term)
  WHERE list_has_all(words[greatest(p - {WINDOW_WORDS - 1}, 1):p + {WINDOW_WORDS - 1}], win) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_near, 0) AS n_near, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN close USING (doc_id)
"""
