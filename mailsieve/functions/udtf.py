"""Table functions."""

from __future__ import annotations

from pyspark.sql.functions import udtf

from mailsieve.functions.text import est_tokens  # noqa: F401 - same token rule as the column function


@udtf(returnType="chunk_index bigint, chunk string, start_char bigint, end_char bigint")
class chunk_text:
    """Fixed windows of one text as a lateral table."""

    def eval(self, text: str, size: int, overlap: int):
        length = max(size, 1) * 4
        step = length - min(max(overlap, 0), max(size, 1) - 1) * 4
        start = index = 0
        while text and start < len(text):
            end = min(start + length, len(text))
            yield index, text[start:end], start, end
            if end == len(text):
                return
            start, index = start + step, index + 1
