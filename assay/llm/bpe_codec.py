"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A row of tokens is the encoding of a word exactly if every two neighbours are: no merge across
their border comes before the merges that use up the pieces beside it. So a word is read from
left to right, always taking the longest token that an Aho-Corasick machine finds at the place
and that fits its predecessor; if none is left, the last token is taken back for its next
shorter one. Only one encoding leads to a place, so each place fails once at most and the work
is linear in the word. Which neighbours fit is kept in a table that fills as pairs are met.

Vocabulary, merges and the tokens proven to encode alone as one are prepared on the driver and
sent to the tasks; their size is that of the vocabulary file.
"""

import json
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import table

#: Stands for the end of a word in the text that the machine reads; no byte-level symbol is equal to it.
END = "\ue000"
KNOWN_CHUNKS, KNOWN_WORDS, LONGEST_KNOWN, KNOWN_PAIRS, ROWS_AT_ONCE = 150_000, 300_000, 64, 250_000, 500
#: Printable ASCII and Latin letters: composed, and of the same kind and lower case in every Unicode version.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: Steps of a file whose pre-tokens a regular expression finds alone, if the text is plain.
PLAIN_STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
DECODED_AT_ONCE = 1 << 20
NEVER = 1 << 62


def _byte_letters() -> dict[int, int]:
    """Bytes as letters: printable ones stand for themselves, the rest take code points from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + i for i, byte in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


@dataclass
class Vocabulary:
    """What tasks need of a vocabulary file; sent to them once."""

    shell: str  # the file without its model: normaliser, pre-tokeniser and added tokens
    suffix: str
    tokens: list[str]  # by id; "" for ids without a token
    parts: dict[int, tuple[int, int]]  # the two tokens that a token is merged from
    rank: dict[tuple[int, int], int]  # the place of a merge in their order
    whole: list[int]  # ids of tokens whose own text is encoded as that one token
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] is not None:
            raise ValueError(f"{path}: a BPE file with word ends and without a decoder is needed")
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        if any(re.search(r"\s", text) for text in special):
            raise ValueError("added tokens must not hold white space")
        tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
        for text, i in [*ids.items(), *special.items()]:
            tokens[i] = text
        parts, rank = {}, {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, merged = (ids[left], ids[right]), ids[left + right]
            if merged in parts:
                raise ValueError(f"merge {place} makes a token a second time")
            parts[merged], rank[pair] = pair, place
        for pair, place in rank.items():
            if any(p in parts and rank[parts[p]] >= place for p in pair):
                raise ValueError(f"merge {place} uses a token that is made later")
        shell = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}}
        found = cls(json.dumps(shell), suffix, tokens, parts, rank, [], special)
        found.whole = found._proven(ids.values())
        return found

    def _proven(self, ids) -> list[int]:
        """A token's text becomes that token if its parts' texts become them and no other merge crosses earlier."""
        proven: dict[int, bool] = {}
        # A token has a higher rank than its parts, so parts come first in this order.
        for token in sorted(ids, key=lambda i: self.rank[self.parts[i]] if i in self.parts else -1):
            pair = self.parts.get(token)
            proven[token] = pair is None or (
                proven[pair[0]] and proven[pair[1]] and self.first_crossing(*pair) == self.rank[pair]
            )
        return [i for i, yes in proven.items() if yes]

    def edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The pieces that stand at one edge of a token while it is built, and the rank at which each is used up."""
        gone = NEVER
        while True:
            yield token, gone
            pair = self.parts.get(token)
            if pair is None:
                return
            token, gone = pair[side], self.rank[pair]

    def first_crossing(self, a: int, b: int) -> int | None:
        """Rank of the first merge across the border of two tokens, if one comes before they are complete.

        Of equal merges the left one goes first: a piece that is used up on its left by the same
        merge is gone, one that would be used up on its right is not.
        """
        found = None
        right = list(self.edge(b, 0))
        for x, x_gone in self.edge(a, 1):
            for y, y_gone in right:
                at = self.rank.get((x, y))
                if at is not None and at < x_gone and at <= y_gone and (found is None or at < found):
                    found = at
        return found


class Encoder:
    """Ids of texts, as packed little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        shell = Tokenizer.from_str(vocabulary.shell)
        self.normalizer, self.pre_tokenizer = shell.normalizer, shell.pre_tokenizer
        texts = {
            i: text.removesuffix(vocabulary.suffix) + END if text.endswith(vocabulary.suffix) else text
            for i, text in ((i, vocabulary.tokens[i]) for i in vocabulary.whole)
        }
        by_text = {text: i for i, text in texts.items()}
        # Texts are read backwards, so that what ends at a place is what starts there.
        self.machine = ahocorasick.Automaton()
        for text, i in by_text.items():
            self.machine.add_word(text[::-1], i)
        self.machine.make_automaton()
        self.length, self.shorter = [0] * len(vocabulary.tokens), [-1] * len(vocabulary.tokens)
        for text, i in by_text.items():
            self.length[i] = len(text)
            self.shorter[i] = next((by_text[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_text), -1)
        spec = json.loads(vocabulary.shell)
        steps = [*spec["normalizer"].get("normalizers", []), *spec["pre_tokenizer"].get("pretokenizers", [])]
        self.split = None
        if [step["type"] for step in steps] == PLAIN_STEPS and steps[3]["invert"] and steps[3]["behavior"] == "Removed":
            import regex

            # White space is all that the replacement changes, and plain text has none.
            self.split = regex.compile(steps[3]["pattern"]["Regex"])
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, special))})") if special else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether the encoding of the two texts in a row is just the two tokens."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.vocabulary.first_crossing(a, b) is None
        return known

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token, given in the byte alphabet of the vocabulary."""
        text = word + END
        top = len(text) - 1
        # Of the matches at one place the longest is reported first, so it is entered last.
        longest = dict(reversed([*self.machine.iter(text[::-1])]))
        length, shorter, pairs = self.length, self.shorter, self.pairs
        tokens: list[int] = []
        failed: set[int] = set()
        at, token, last = 0, longest.get(top, -1), -1
        while at <= top:
            while token >= 0:
                if at + length[token] not in failed:
                    fits = last < 0 or pairs.get((last, token))
                    if fits or (fits is None and self.fits(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                last, token = token, longest.get(top - at, -1)
            elif tokens:
                failed.add(at)
                last = tokens.pop()
                at -= length[last]
                token, last = shorter[last], tokens[-1] if tokens else -1
            else:
                raise ValueError(f"no encoding: {word[:100]!r}")
        return tokens

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens in the byte alphabet."""
        if self.split and PLAIN.fullmatch(text):
            found = self.split.findall(text.lower())
            return found if text.isascii() else [p.encode().decode("latin-1").translate(BYTE_LETTERS) for p in found]
        return [p for p, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def chunk(self, chunk: bytes) -> bytes:
        """Ids of a stretch without white space; a chunk that is met again is looked up."""
        text = chunk.decode(errors="replace")
        found: list[bytes] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.vocabulary.special:
                found.append(np.array([self.vocabulary.special[part]], "<u4").tobytes())
            elif part:
                found += [self.words.get(piece) or self.learn(piece) for piece in self.pieces(part)]
        ids = b"".join(found)
        if len(chunk) <= LONGEST_KNOWN:
            if len(self.chunks) >= KNOWN_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def learn(self, piece: str) -> bytes:
        packed = array("I", self.word(piece))
        if sys.byteorder != "little":
            packed.byteswap()
        ids = packed.tobytes()
        if len(piece) <= LONGEST_KNOWN:
            if len(self.words) >= KNOWN_WORDS:
                self.words.clear()
            self.words[piece] = ids
        return ids

    def text(self, text: bytes) -> bytes:
        known = self.chunks.get
        return b"".join([known(chunk) or self.chunk(chunk) for chunk in text.split()])


class Decoder:
    """Texts of packed ids: the tokens' texts with one blank between them, as the library joins them."""

    def __init__(self, tokens: list[str]):
        encoded = [token.encode() + b" " for token in tokens]
        self.bytes = np.frombuffer(b"".join(encoded), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])

    def text(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        parts = [self._some(ids[i : i + DECODED_AT_ONCE]) for i in range(0, len(ids), DECODED_AT_ONCE)]
        return b"".join(parts)[:-1]

    def _some(self, ids: np.ndarray) -> bytes:
        first = self.offsets[ids]
        size = self.offsets[ids + 1] - first
        ends = np.cumsum(size)
        return self.bytes[np.arange(ends[-1]) + np.repeat(first - (ends - size), size)].tobytes()


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that little is held beside the batch itself."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs(doc_id, text, ...)``.

    ``path`` names, on the driver, a BPE file of the tokenizers library with word ends; strings of
    its added tokens in a text become those tokens. ``ids`` is packed as little-endian unsigned 32-bit
    integers. Null and empty texts give no ids, repeated rows a row each, and an empty table no rows;
    other columns, whatever their names, are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in _small(batches):
            if encoder is None:
                encoder = Encoder(shared.value)
            ids = [encoder.text(text.as_py() or b"") for text in batch.column("text")]
            tokens = pa.array([len(packed) // 4 for packed in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), tokens, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text`` for every row of :func:`encode`; no ids give an empty text, null ids null."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in _small(batches):
            if decoder is None:
                decoder = Decoder(shared.value)
            packed = [ids.as_py() for ids in batch.column("ids")]
            texts = pa.array([None if ids is None else decoder.text(ids) for ids in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "text"])

    plain = encoded.select("doc_id", "n_tokens", "ids")
    texts = plain.mapInArrow(run, "doc_id long, n_tokens long, ids binary, text binary")
    return texts.withColumn("text", F.col("text").cast("string"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text, per document; odd input as in :func:`encode`."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return texts.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op11_bpe_codec": op11_bpe_codec}
