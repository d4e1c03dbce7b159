"""Text of nested content: a string as it is; of objects all `content` strings, an object's own before its children's."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def content_text(raw: str | None) -> str:
    try:
        value = json.loads(raw or "")
    except ValueError:
        return raw or ""
    if isinstance(value, str):
        return value
    found: list[str] = []
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if isinstance(x.get("content"), str):
                found.append(x["content"])
            stack += [v for k, v in reversed(x.items()) if not (k == "content" and isinstance(v, str))]
        elif isinstance(x, list):
            stack += reversed(x)
    return "\n".join(found) if found else json.dumps(value, ensure_ascii=False)


@F.pandas_udf(StringType())
def nested_text(raw: pd.Series) -> pd.Series:
    return raw.map(content_text)
