"""Text search: token postings, and documents that hold all or any of some words, or a phrase.

A posting is a row (token, document, times), never a list of documents, so a word that is in a
third of all texts is spread over as many tasks and files as it needs. Words are lower case and
not stemmed; English stop words are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import split_words
from ..model import STOP_WORDS
from ..session import MOST_PARTITIONS


# Bytes of text whose words go to one range of an index, so that they are sorted in memory.
TEXT_PER_RANGE = 8 << 20


def _dealt(words: DataFrame, keys: Sequence[str], ranged: bool, df: DataFrame, text: str) -> DataFrame:
    """Words dealt by the keys they are grouped by next: to all partitions of the session, or to as
    many ranges as the texts ask for.

    Most words come once or twice in a document. Groups made before the shuffle would be nearly as
    many as the words of a task's whole input, and be spilled; adaptive execution would make too few
    and too large ones of the partitions after it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not ranged:
        return words.repartition(parts, *keys)
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return words.repartitionByRange(min(MOST_PARTITIONS, max(parts, -(-size // TEXT_PER_RANGE))), "token", "doc")


def postings(df: DataFrame, doc: str, text: str, ranged: bool = False) -> DataFrame:
    """Times that each document holds each token; common words are spread over all tasks.

    ``ranged`` deals words by ranges of (token, document), for ``write_postings``, which then has
    nothing left to deal; their number follows the size of the texts and they are cut by a sample, so the texts are read
    three times.
    """
    tokens = df.select(F.col(doc).alias("doc"), F.explode(split_words(text)).alias("token"))
    kept = tokens.filter((F.col("token") != "") & ~F.col("token").isin(STOP_WORDS))
    return _dealt(kept, ["token", "doc"], ranged, df, text).groupBy("token", "doc").agg(F.count("*").alias("times"))


def write_postings(df: DataFrame, path: str, ranged: bool = False) -> None:
    """Write postings sorted by token over ranges of equal size.

    Ranges are cut by (token, document): a common word spans many files, and the token bounds in
    each file's footer let a search skip the others. ``ranged`` says that ``df`` was made so.
    """
    dealt = df if ranged else df.repartitionByRange("token", "doc")
    dealt.sortWithinPartitions("token", "doc").write.parquet(path)


def load_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def query_words(spark: SparkSession, query: str) -> list[str]:
    """Distinct lower-case words of a query without stop words, in order.

    The query is cut by the same expression as the documents, so words in any script are found.
    """
    found = spark.range(1).select(split_words(F.lit(query)).alias("words")).first()["words"]
    return [w for w in dict.fromkeys(found) if w and w not in STOP_WORDS]


def _hits(index: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return index.filter(F.col("token").isin(list(wanted))).groupBy("doc").agg(
        F.count("*").alias("matched"), F.sum("times").alias("times")
    )


def search_all(index: DataFrame, query: str) -> DataFrame:
    """Documents that hold every word of the query."""
    wanted = query_words(index.sparkSession, query)
    return _hits(index, wanted).filter(F.col("matched") == len(wanted))


def search_any(index: DataFrame, query: str) -> DataFrame:
    """Documents that hold at least one word of the query."""
    return _hits(index, query_words(index.sparkSession, query))


# Places of a token in a document are kept in pieces of the text of so many words.
PIECE_WORDS = 4096


def positions(df: DataFrame, doc: str, text: str, ranged: bool = False) -> DataFrame:
    """Places of each token in each document, in rows (token, document, piece, places).

    Words are counted from 0, stop words too, so distances are those of the text. A row has the
    places within one piece of the text, so no list grows with the text. Null texts have no words.
    ``ranged`` is that of ``postings``.
    """
    words = F.filter(split_words(text), lambda word: word != "")
    places = df.select(F.col(doc).alias("doc"), F.posexplode(words).alias("place", "token"))
    kept = places.filter(~F.col("token").isin(STOP_WORDS)).withColumn("piece", F.floor(F.col("place") / PIECE_WORDS))
    return _dealt(kept, ["token", "doc", "piece"], ranged, df, text).groupBy("token", "doc", "piece").agg(F.sort_array(F.collect_list("place")).alias("places"))


def _places(index: DataFrame, tokens: Sequence[str]) -> DataFrame:
    return index.filter(F.col("token").isin(list(tokens))).select("token", "doc", F.explode("places").alias("place"))


def search_phrase(index: DataFrame, phrase: str) -> DataFrame:
    """Documents that hold the words of a phrase in its order, and how often.

    A stop word of the phrase stands for any word. Every place of a word of the phrase says where
    the phrase would start; where all its words say so, it does. A phrase without any other words
    is in no document. ``index`` is what ``positions`` gives.
    """
    cut = index.sparkSession.range(1).select(F.filter(split_words(F.lit(phrase)), lambda word: word != "").alias("w"))
    offsets: dict[str, list[int]] = {}
    for offset, word in enumerate(cut.first()["w"]):
        if word not in STOP_WORDS:
            offsets.setdefault(word, []).append(offset)
    wanted = sum(map(len, offsets.values()))
    at = F.lit(None).cast("array<int>")
    for word, places in offsets.items():
        at = F.when(F.col("token") == word, F.array(*map(F.lit, places))).otherwise(at)
    starts = _places(index, list(offsets)).select("doc", "place", F.explode(at).alias("offset")).select(
        "doc", (F.col("place") - F.col("offset")).alias("start"))
    whole = starts.groupBy("doc", "start").agg(F.count("*").alias("n")).filter(F.col("n") == wanted)
    return whole.groupBy("doc").agg(F.count("*").alias("times"))


def search_near(index: DataFrame, query: str, within: int) -> DataFrame:
    """Documents that hold every word of a query within so many words, and where they first do.

    ``start`` is the first place from which ``within`` words of the text hold them all. Stop words
    of the query do not count. ``index`` is what ``positions`` gives.
    """
    wanted = query_words(index.sparkSession, query)
    ahead = Window.partitionBy("doc").orderBy("place").rangeBetween(0, within - 1)
    found = _places(index, wanted).withColumn("near", F.size(F.collect_set("token").over(ahead)))
    return found.filter(F.col("near") == len(wanted)).groupBy("doc").agg(F.min("place").alias("start"))
