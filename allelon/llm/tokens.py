"""Batch encoding in Arrow functions: token counts, and the ids that packing needs.

A tokenizer whose pieces never cross white space gives a text the same tokens as its words one by one. Texts
are split at those safe boundaries, very long words where a letter meets a mark; each word is encoded once and remembered in a
bounded table, and what isn't remembered goes to the library in batches of equal bytes.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import by_bytes, kept, parts, texts_of

_ODD_SPACE = re.compile("[\x1c-\x1f]")
_ASCII_SPACE = re.compile("[ \t\n\x0b\x0c\r]+")
#: Where a text may be cut: before a lone blank, and (of texts without special strings) between a letter or digit and a mark. Tokenizers that
#: keep letters, digits and marks apart have no token across such a place, and no normal form joins the two sides.
_BLANK = re.compile(r"(?<=\S)(?= \S)")
_SAFE = re.compile(r"(?<=\S)(?= \S)|(?<=[A-Za-z0-9\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5])(?=[\t\n\r -/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1f])")
#: Longer texts are encoded in parts, and words longer than WORD_BYTES as well.
LONG, WORD_BYTES = 1 << 20, 1 << 16
#: Longer words aren't kept between batches.
KEPT_LETTERS = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable in Latin-1, else the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def words_at_space(text: str) -> list[str]:
    """Words between white space, for tokenizers that drop white space."""
    if _ODD_SPACE.search(text):  # Python alone counts these as white space
        return [w for w in _ASCII_SPACE.split(text) if w]
    return text.split()


def safe_parts(text: str, size: int = LONG) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at the first safe place after each; a text without such a place stays whole."""
    at, place = 0, _BLANK if "<|" in text else _SAFE
    while len(text) - at > size and (cut := place.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class WordTable:
    """word -> what ``make`` gives for it, over at most about ``most`` words of up to ``letters`` letters, and the longer ones of the last call.

    There are two generations: when the young one is half of ``most``, it becomes the old one, from which words that occur again come back.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int = 600_000, letters: int = KEPT_LETTERS, always: dict | None = None, batch_bytes: int = 1 << 17):
        self.make, self.most, self.letters, self.always, self.batch_bytes = make, most, letters, always or {}, batch_bytes
        self.held, self.old, self.long = dict(self.always), {}, []

    def fill(self, words: set[str]) -> dict:
        """The young generation, with all of ``words`` in it."""
        for w in self.long:
            del self.held[w]
        new = [w for w in words if w not in self.held]
        if len(self.held) + len(new) > self.most // 2:
            self.old, self.held = self.held, self.always | {w: self.held[w] for w in words if w in self.held}
        old = self.old
        self.held.update((w, old[w]) for w in new if w in old)
        new = [w for w in new if w not in old]
        self.long = [w for w in new if len(w) > self.letters]
        for part in by_bytes(new, self.batch_bytes):
            self.held.update(zip(part, self.make(part), strict=True))
        return self.held


def library_encoder(path: str):
    """The tokenizers library's tokenizer of a file, without truncation and padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def length_table(path: str, most: int = 600_000) -> WordTable:
    own = library_encoder(path)
    return WordTable(lambda part: [len(e) for e in own.encode_batch_fast(part, add_special_tokens=False)], most)


class ByteIds:
    """Whole texts to ids for a byte-level file whose token ids are in merge order.

    Texts with a special string go to the tokenizers library itself, all others to the same merges in tiktoken, which
    gives the same ids several times faster.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.library = library_encoder(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a long text is encoded in parts that no token crosses."""
        return b"".join(map(self._part, safe_parts(text)))

    def _part(self, text: str) -> bytes:
        if "<|" in text:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).tobytes()


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row, by a tokenizer file that drops white space; only lengths leave the Arrow function.

    Null texts count as empty and have no tokens; a text of any length is encoded whole. Repeated rows give repeated results, a null id
    stays null, other columns aren't read, and an empty table gives an empty result.
    """
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(("lengths", tokenizer_path), lambda: length_table(tokenizer_path))
        for batch in parts(batches):
            split = []
            for text in texts_of(batch, "text"):
                words = words_at_space(text)
                if words and max(map(len, words)) > WORD_BYTES:
                    words = [p for w in words for p in safe_parts(w, WORD_BYTES)]
                split.append(words)
            held = table.fill(set().union(*split))
            found = [sum(map(held.__getitem__, words)) for words in split]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
