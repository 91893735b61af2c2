"""Files to pages: one row per page, with the byte decoder as a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

Decoder = Callable[[bytes], Iterable[str]]

_PAGES = "path string, page_no int, text string"


def plain_text_pages(content: bytes) -> list[str]:
    """Default decoder: UTF-8 text with form feeds between pages."""
    return content.decode("utf-8", errors="replace").split("\f")


def ingest_files(
    spark: SparkSession, path: str, decoder: Decoder = plain_text_pages, pattern: str = "*"
) -> DataFrame:
    """(path, page_no, text) for every page of every file, decoded in the tasks that read them."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "content")
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                pages = list(decoder(bytes(content)))
                yield pd.DataFrame(
                    {"path": name, "page_no": range(1, len(pages) + 1), "text": pages}
                )

    return files.mapInPandas(decode, _PAGES)
