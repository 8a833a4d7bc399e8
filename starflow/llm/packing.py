"""Packing by power-of-two decomposition.

Every document is cut into pieces whose lengths are powers of two, longest first, and every piece
is a sequence of its own. So no sequence crosses documents, nothing is padded, and batches are
made of sequences of one length (the ``bucket``).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import in_batches, texts_of

MAX_LENGTH = 2048
END_ID = 1

# Words of which a worker remembers the ids. When it knows more, it starts anew: only speed depends
# on it, never an id.
REMEMBERED = 600_000

# How a tokenizer must normalise and split for its words to be encoded one by one.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END_MARK = "</w>"

# The words of that splitting rule, for texts in Latin-1.
_WORD = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    rb"|[^\sa-z0-9\x85\xa0\xaa\xb5\xb2\xb3\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+"
)
_LOWER = bytes(
    ord(chr(i).lower()) if len(chr(i).lower()) == 1 and ord(chr(i).lower()) < 256 else i
    for i in range(256)
)


class WordIds:
    """Token ids of texts, as little-endian unsigned 32-bit bytes; equal words are encoded once.

    The tokenizer encodes each word (a run of letters, one digit, a run of other characters) on
    its own, in lower case. So the ids of a text are those of its words, one after the other.
    Texts outside Latin-1 go to the tokenizer as they are, and so do all texts if the file says that
    the tokenizer works in another way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _encodes_words(json.loads(Path(path).read_text("utf-8")))
        # Each word ends in one token that carries the end mark.
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith(END_MARK)]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[ends] = True
        self.known: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype="<u4")

    def _learn(self, words: list[bytes]) -> None:
        ids = self._encode(" ".join(w.decode("latin-1") for w in words))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words) and (not len(cuts) or cuts[-1] == len(ids)):
            data, start = ids.tobytes(), 0
            for word, end in zip(words, (cuts * 4).tolist()):
                self.known[word] = data[start:end]
                start = end
        else:
            for word in words:
                self.known[word] = self._encode(word.decode("latin-1")).tobytes()

    def of(self, text: str) -> bytes:
        if not self.by_word:
            return self._encode(text).tobytes()
        try:
            data = unicodedata.normalize("NFC", text).encode("latin-1")
        except UnicodeEncodeError:
            return self._encode(text).tobytes()
        if b"<|" in data:  # may hold the text of a special token
            return self._encode(text).tobytes()
        words = _WORD.findall(data.translate(_LOWER))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({w for w in words if w not in self.known})
        if new:
            self._learn(new)
        return b"".join(map(self.known.__getitem__, words))


def _encodes_words(file: dict) -> bool:
    """Whether a tokenizer file has the normaliser, the splitter and the end mark that ``WordIds``
    goes by, and adds nothing of its own."""
    steps = (file.get("normalizer") or {}).get("normalizers", [])
    splits = (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [step["type"] for step in steps] == NORMALIZERS
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and [split["type"] for split in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": SPLIT}
        and not splits[1]["add_prefix_space"]
        and not splits[1]["use_regex"]
        and file["model"].get("end_of_word_suffix") == END_MARK
        and file.get("truncation") is None
    )


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker and tokenizer file."""
    return WordIds(path)


def pieces_of(n: int, longest: int) -> list[int]:
    """Powers of two, longest first, that sum up to ``n``; none is over ``longest``."""
    return [longest] * (n // longest) + [
        1 << b for b in range(longest.bit_length() - 2, -1, -1) if n % longest >> b & 1
    ]


_PIECES = "start bigint, length bigint, ids binary, doc_tokens bigint"


def decompose(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, bucket, sequence_id, offset``.

    ``max_length`` must be a power of two. ``ids`` are little-endian unsigned 32-bit numbers.
    ``start`` counts the document's ids before the piece and ``doc_tokens`` all of them, with the
    closing ``end_id``. ``sequence_id`` is unique; ``offset`` is always 0, as each piece fills its
    sequence. NULL and empty texts give one piece that is the ``end_id`` alone. A NULL or repeated
    id is passed on as it is, each row giving its own pieces; an empty table gives no rows. Other
    columns of ``docs`` are not read, so their names do not matter. There is no shuffle: each
    text is read once, where it lies.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    in_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = word_ids(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            row, start, length, ids, total = [], [], [], [], []
            for i, text in enumerate(texts_of(batch)):
                data = encoder.of(text) + last
                at, n = 0, len(data) // 4
                for size in pieces_of(n, max_length):
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    ids.append(data[4 * at : 4 * (at + size)])
                    total.append(n)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()),
                ],
                names=["id", "start", "length", "ids", "doc_tokens"],
            )

    return rows.mapInArrow(cut, f"id {id_type}, {_PIECES}").select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids",
        "doc_tokens",
        F.col("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length, for batches of equal sequences.

    An empty table makes an empty folder. The folder must not be there before."""
    pieces.write.partitionBy("bucket").parquet(path)
