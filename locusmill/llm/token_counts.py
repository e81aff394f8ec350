"""Token counts with a whole-token shortcut.

Which vocabulary strings encode alone as one token is proved beforehand by encoding each of them. Texts are cut
into words and pre-tokens; those proved count one token each, and only the rest are merged, each distinct one once a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from locusmill.llm.tokens import encode
from locusmill.llm.words import slices, sums


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text; null and empty texts have none.

    ``tokenizer`` is the path of a tokenizer file on the driver; its content goes to the executors. Rows stay as they are,
    in number and order; columns of these two names are replaced.
    """
    docs = docs.drop("n_bytes", "n_tokens")
    spec = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, mb=16, gather=True):
            _, offsets, units, at = encode(b.column(text), spec.value)
            n = sums(np.diff(offsets)[units], at)
            size = pc.cast(pc.fill_null(pc.binary_length(b.column(text)), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, size, pa.array(n, pa.int64())], [*b.schema.names, "n_bytes", "n_tokens"])

    schema = StructType([*docs.schema.fields, StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return docs.mapInArrow(count, schema)


def op7_whole_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """The contract's query."""
    import public_tokenizers

    counted = count_tokens(docs.select("doc_id", "text"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
