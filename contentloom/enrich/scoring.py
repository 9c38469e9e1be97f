"""Hook for a user's own model: prompt column, batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contentloom.functions.core import col
from contentloom.functions.text import normalize_text, truncate

#: What a model is asked about a text; another mapping can be given.
INSTRUCTIONS = {
    "summary": "Sum up the following text in a few sentences.",
    "title": "Suggest a title for the following text.",
    "style": "Name the writing style of the following text.",
}


def _whole(body: Column | str, max_chars: int | None) -> Column:
    return col(body) if max_chars is None else truncate(col(body), max_chars)


def model_text(body: Column | str, max_chars: int | None = None) -> Column:
    """The normalised text, whole unless the model has an input limit."""
    return normalize_text(_whole(body, max_chars))


def prompt(
    body: Column | str,
    task: str,
    max_chars: int | None = None,
    instructions: Mapping[str, str] = INSTRUCTIONS,
) -> Column:
    """Instruction and text of a model call, the text between markers."""
    head = f"{instructions[task]}\n<text>\n"
    return F.concat(F.lit(head), _whole(body, max_chars), F.lit("\n</text>"))


def score_batches(
    df: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[pd.Series], pd.Series]],
    result: str,
    result_type: T.DataType | str,
) -> DataFrame:
    """Apply a model to a text column in Arrow batches.

    ``load_model`` runs once per partition, and its result maps a batch of texts to a
    batch of values. The text itself is not returned.
    """
    kept = df.drop(text).schema
    out = T.StructType(list(kept.fields)).add(
        result, T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    )
    names = kept.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            yield batch[names].assign(**{result: model(batch[text])})

    return df.mapInPandas(run, out)
