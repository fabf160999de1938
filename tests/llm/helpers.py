"""Small tables with the cases every operator must stand."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    words = [f"w{r.randrange(vocabulary)}x" if r.random() < 0.1 else "".join(r.choices("aeinrst", k=r.randrange(1, 8))) for _ in range(n)]
    return " ".join(w + (".\n" if r.random() < 0.05 else "") for w in words)


def edge_texts() -> list[str | None]:
    """Null, empty, blank, one word, odd white space, other scripts, controls, a long word, repeats."""
    return [None, "", "   \n\t ", "one", " lead and  double   blanks ", "tab\tand\x0bvertical\x0c\r\nend", "日本語のテキスト と 한국어",
            "Ärger über Øl, naïve café — “quotes” 😀", "\x00\x01 control \x7f", "a" * 5000, "same same same same same same",
            "▁mark ▁▁ mark", "<|endoftext|> special </s>", "x y z \x1c\x85 end", "\n\n\n", "Case CASE case"]


def documents(spark: SparkSession, texts: list[str | None], first: int = 0, sources: int = 3) -> DataFrame:
    rows = [(first + i, t, "en" if i % 2 else "de", None if i % 11 == 5 else f"s{i % sources}", len(t) if t is not None else None)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def null_row(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, None, None, None, None)], DOC)


def no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOC)


def clashing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with extra columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("extra") for n in names if n not in df.columns})
