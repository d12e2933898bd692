"""The whole corpus as ids of a public byte-level BPE (problem 8).

Distinct-word table: Spark splits each text with the vocabulary's own word pattern, every
distinct word is encoded once, and the ids are joined back by position. A word that makes up
more than 1/4096 of all words is hot; there are fewer than 4096 such words in any corpus, so their ids are broadcast
and never shuffled. The rest goes through a shuffled join. The texts are hashed by document
first, so that splitting, the broadcast join and the regrouping share one partitioning.

Defined results: a null or empty text gives an empty list of ids; strings that look like special
tokens are ordinary text. Rows with a null id are dropped; a repeated id counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.dist import cut, heavy_keys

# Fixed value: the word pattern of the vocabulary; (?U) gives \s its Unicode meaning on the JVM.
WORDS = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZERS = "/opt/tokenizers"


def load(folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{folder}/{name}.json")
    t.encode_special_tokens = True
    return t


def split_words(docs: DataFrame) -> DataFrame:
    """``doc_id, pos, word`` for each word of ``doc_id, text``."""
    return docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))).alias("pos", "word"))


def encode_words(words: DataFrame, folder: str) -> DataFrame:
    """``word, ids`` for a table of distinct words."""
    import pyarrow as pa

    def run(batches):
        t = load(folder)
        for b in batches:
            got = t.encode_batch(b.column(0).to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([e.ids for e in got], pa.list_(pa.int32()))], names=["word", "ids"])

    return words.select("word").mapInArrow(run, "word string, ids array<int>")


def encode(docs: DataFrame, folder: str = TOKENIZERS, share: int = 4096) -> DataFrame:
    """``doc_id, ids`` for each document of ``docs`` (``doc_id, text`` and any other columns)."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    docs = docs.groupBy("doc_id").agg(F.max("text").alias("text"))  # also places all later work by document
    words = split_words(docs)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    table = cut(encode_words(counts, folder).join(counts, "word"))
    total = table.agg(F.sum("n").alias("total"))
    hot = cut(table.join(F.broadcast(total), F.col("n") * share > F.col("total")).select("word", "ids"))
    cold = table.join(F.broadcast(hot.select("word")), "word", "left_anti").select("word", "ids")
    placed = words.join(F.broadcast(hot), "word", "left")
    merge = lambda ids: F.array_sort(F.collect_list(F.struct("pos", ids)))
    by_hot = placed.where("ids IS NOT NULL").groupBy("doc_id").agg(merge("ids").alias("a"))
    by_cold = placed.where("ids IS NULL").select("doc_id", "pos", "word").join(cold, "word").groupBy("doc_id").agg(merge("ids").alias("b"))
    all_docs = docs.select("doc_id").join(by_hot, "doc_id", "left").join(by_cold, "doc_id", "left")
    empty = "cast(array() as array<struct<pos:int,ids:array<int>>>)"
    both = F.array_sort(F.concat(F.coalesce("a", F.expr(empty)), F.coalesce("b", F.expr(empty))))
    return all_docs.select("doc_id", F.flatten(F.transform(both, lambda s: s["ids"])).alias("ids"))


def pieces(spark: SparkSession, folder: str = TOKENIZERS) -> DataFrame:
    """``id, bytes``: the vocabulary, a table of fixed size (50,257 rows)."""
    t = load(folder)
    back = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    n = 0
    for b in range(256):
        if b in plain:
            back[chr(b)] = b
        else:
            back[chr(256 + n)] = b
            n += 1
    rows = [(i, bytearray(back[c] for c in w) if all(c in back for c in w) else bytearray(w.encode())) for w, i in t.get_vocab().items()]
    return spark.createDataFrame(rows, "id int, bytes binary")


def decode(encoded: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` by a join of each id to its piece.

    An empty or null list gives ''. The pieces are a fixed 50,257 rows and are broadcast.
    """
    table = pieces(encoded.sparkSession, folder)
    each = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    joined = each.join(F.broadcast(table), "id", "left")
    grouped = joined.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("bytes").alias("h")))).alias("p"))
    whole = F.array_join(F.transform("p", lambda s: s["h"]), "")
    return grouped.select("doc_id", F.decode(F.unhex(whole), "UTF-8").alias("text"))
