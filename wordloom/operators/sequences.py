"""Word ids and fixed-length id sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from wordloom.functions.words import split_clean_words
from wordloom.operators.ordering import with_rank
from wordloom.options import Options
from wordloom.session import cut

# The reserved words and their ids.
RESERVED = {"<PAD>": 0, "<UNK>": 1, "<START>": 2, "<END>": 3}

HEAD_ROWS = 100_000
HEAD_WORD_BYTES = 256


def id_vocabulary(docs: DataFrame, min_freq: int = 2) -> DataFrame:
    """(word, word_id, total_count): reserved ids first, then the words in sorted order.

    `docs` are lightly cleaned. The table grows with the corpus, so the ids come from a range
    partitioned rank and never from a sort in one task.
    """
    words = docs.select(F.explode_outer(split_clean_words(F.col("text"))).alias("word"))
    counts = words.filter(F.col("word") != "").groupBy("word").agg(
        F.count("*").alias("total_count")
    )
    ranked = with_rank(counts.filter(F.col("total_count") >= min_freq), "word")
    # 32 bits, as models take them; more words than that raise an error.
    number = (F.col("rank") + len(RESERVED)).cast("int").alias("word_id")
    return reserved_words(docs.sparkSession).unionByName(
        ranked.select("word", number, "total_count")
    )


def reserved_words(spark: SparkSession) -> DataFrame:
    entries = [
        F.struct(
            F.lit(word).alias("word"),
            F.lit(number).alias("word_id"),
            F.lit(0).cast("bigint").alias("total_count"),
        )
        for word, number in RESERVED.items()
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def with_word_ids(words: DataFrame, vocab: DataFrame, head_rows: int = HEAD_ROWS) -> DataFrame:
    """Add `word_id` to rows with a `word`; unknown words get the id of <UNK>.

    The most frequent words of the rows themselves, in the vocabulary or not, are looked up first
    and broadcast: a bounded table that settles most rows where they are. What is left are rows of
    rarer words, none of which has more than a `head_rows`-th of all rows, and they meet the whole
    vocabulary in a shuffled join. Size and cores change nothing in that.
    """
    lookup = vocab.select("word", "word_id")
    counts = words.filter(F.octet_length("word") <= HEAD_WORD_BYTES).groupBy("word").agg(
        F.count("*").alias("n")
    )
    frequent = counts.orderBy(F.desc("n"), F.asc("word")).limit(head_rows).select("word")
    unknown = F.lit(RESERVED["<UNK>"]).cast(vocab.schema["word_id"].dataType)
    head = cut(
        frequent.join(lookup, "word", "left").select(
            "word", F.coalesce("word_id", unknown).alias("_head_id")
        )
    )
    tried = words.join(F.broadcast(head), "word", "left")
    settled = tried.filter(F.col("_head_id").isNotNull())
    rest = tried.filter(F.col("_head_id").isNull()).drop("_head_id").join(lookup, "word", "left")
    return settled.select(*words.columns, F.col("_head_id").alias("word_id")).unionByName(
        rest.select(*words.columns, F.coalesce("word_id", unknown).alias("word_id"))
    )


def bounded_id_sequences(docs: DataFrame, words: Sequence[str], options: Options = Options()) -> DataFrame:
    """What `id_sequences` gives where the vocabulary is bounded and on the driver: `words` have
    the ids after the reserved ones, in order. They are sent to the workers; nothing is shuffled,
    and a document is a row as it came."""
    length, first, unknown = options.sequence_length, len(RESERVED), RESERVED["<UNK>"]
    padding = RESERVED["<PAD>"]
    sent = docs.sparkSession.sparkContext.broadcast(list(words))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.string())
        for batch in batches:
            listed = pc.split_pattern(batch["_text"], " ")
            sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
            place = pc.index_in(pc.list_flatten(listed), known)
            ids = pc.fill_null(pc.add(place, first), unknown).to_numpy(zero_copy_only=False)
            used = np.arange(length) < sizes[:, None]
            table = np.full(used.shape, padding, np.int32)
            table[used] = ids
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * length)
            columns = [
                pa.ListArray.from_arrays(offsets, pa.array(cells.astype(np.int32).ravel()))
                for cells in (table, used)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *columns], ["doc_id", "input_ids", "attention_mask"]
            )

    # Words past the end of a sequence are cut off before they travel.
    fitting = F.substring_index(F.lower(F.coalesce("text", F.lit(""))), " ", length)
    lowered = docs.select("doc_id", fitting.alias("_text"))
    ids = ArrayType(IntegerType())
    schema = lowered.select("doc_id").schema.add("input_ids", ids).add("attention_mask", ids)
    return lowered.mapInArrow(encoded, schema)


def id_sequences(
    docs: DataFrame,
    vocab: DataFrame,
    options: Options = Options(),
    head_rows: int = HEAD_ROWS,
) -> DataFrame:
    """(doc_id, input_ids, attention_mask), both arrays exactly `sequence_length` long.

    Only the words that fit are exploded, so no group exceeds `sequence_length` rows.
    """
    length = options.sequence_length
    fitting = F.slice(split_clean_words(F.col("text")), 1, length)
    listed = docs.select("doc_id", fitting.alias("_words"))
    words = listed.select("doc_id", F.posexplode_outer("_words").alias("pos", "word"))
    numbered = with_word_ids(words, vocab, head_rows)
    placed = numbered.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "word_id"))).alias("_placed")
    )
    ids = F.transform("_placed", lambda entry: entry.word_id)
    padding = F.array_repeat(F.lit(RESERVED["<PAD>"]), length - F.size("_placed"))
    padded = placed.select("doc_id", F.concat(ids, padding).alias("input_ids"))
    mask = F.transform("input_ids", lambda x: (x != RESERVED["<PAD>"]).cast("int"))
    return padded.select("doc_id", "input_ids", mask.alias("attention_mask"))
