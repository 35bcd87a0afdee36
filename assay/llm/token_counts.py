"""Token counts with a whole-token shortcut.

Before any text is read, every vocabulary string that ends a word is encoded alone; those
that give exactly one token are proven whole. A pre-token in that set counts one without any
merging, and only the others go through the merges of the tokenizer. White space separates
pre-tokens in this kind of vocabulary, so each distinct chunk between white space is counted
once per task and looked up afterwards.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import table

WORD_END = "</w>"
KNOWN_CHUNKS = 400_000
LONGEST_KNOWN = 64


def proven_whole(tokenizer) -> set[str]:
    """Pre-tokens (in the byte alphabet of the vocabulary) that encode alone as one token."""
    model = tokenizer.model
    words = (v.removesuffix(WORD_END) for v in tokenizer.get_vocab() if v.endswith(WORD_END))
    return {word for word in words if word and len(model.tokenize(word)) == 1}


class ChunkCounts(dict):
    """Tokens per chunk of bytes; unknown chunks are counted on first use."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.whole = proven_whole(self.tokenizer)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode() for token in added]
        self.merged: dict[str, int] = {}

    def count(self, chunk: bytes) -> int:
        if any(token in chunk for token in self.special):
            return len(self.tokenizer.encode(chunk.decode(errors="replace"), add_special_tokens=False).ids)
        text = self.tokenizer.normalizer.normalize_str(chunk.decode(errors="replace"))
        total = 0
        for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            total += 1 if piece in self.whole else len(self.tokenizer.model.tokenize(piece))
        return total

    def __missing__(self, chunk: bytes) -> int:
        n = self.count(chunk)
        if len(chunk) <= LONGEST_KNOWN:
            if len(self) >= KNOWN_CHUNKS:
                self.clear()
            self[chunk] = n
        return n

    def of(self, text: bytes | None) -> int:
        return sum(map(self.__getitem__, text.split())) if text else 0


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text, ...)``.

    ``path`` names a BPE file of the tokenizers library with word ends. Null texts count as
    empty: 0 bytes, 0 tokens. Repeated rows each give a row; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            if counts is None:  # an empty one is false
                counts = ChunkCounts(path)
            texts = batch.column("text")
            tokens = [counts.of(texts[i].as_py()) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("binary").alias("text"),
    )
    counted = narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op1_token_counts": op1_token_counts}
