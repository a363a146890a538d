"""Word counts over a whole corpus, combined in each map task before the shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import parts, texts_of

#: Longer words are passed on at once instead of being held, so that what a task holds is bounded in bytes.
LONG_WORD = 64


def word_counts(docs: DataFrame, words: Callable[[str], list], text_col: str = "text", group_col: str | None = None, most: int = 300_000) -> DataFrame:
    """(group, word, n) over all texts; a task passes its counts on whenever it holds ``most`` words.

    ``words`` splits a text. Without ``group_col`` the group is null. Null texts have no words.
    """
    group = F.col(group_col).cast("string") if group_col else F.lit(None).cast("string")
    schema = pa.schema([("grp", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}

        def out(found: dict[str | None, Counter]) -> Iterator[pa.RecordBatch]:
            for g, c in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(c), pa.string()), pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], schema=schema)
            found.clear()

        for batch in parts(batches):
            long: dict[str | None, Counter] = {}
            for g, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                own = words(text)
                if own and max(map(len, own)) > LONG_WORD:
                    long.setdefault(g, Counter()).update(w for w in own if len(w) > LONG_WORD)
                    own = [w for w in own if len(w) <= LONG_WORD]
                if (c := held.get(g)) is None:
                    c = held[g] = Counter()
                c.update(own)
            yield from out(long)
            if sum(map(len, held.values())) > most:
                yield from out(held)
        yield from out(held)

    counted = docs.select(group.alias("grp"), F.col(text_col).alias("text")).mapInArrow(count, "grp string, word string, n long")
    return counted.groupBy("grp", "word").agg(F.sum("n").alias("n"))
