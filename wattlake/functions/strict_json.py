"""JSON objects, decoded by a fixed schema, without what the reader lets pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.columns import with_computed_once

_CORRUPT = "_corrupt"


def with_body(rows: DataFrame, text: Column, schema: T.StructType, name: str) -> DataFrame:
    """Add `name`: the object in `text`, or null if the text isn't just one sound object.

    The reader ignores what follows a value. So the text is decoded as the field of an object
    that goes on after it: trailing text, a second object, an array and no text then break it.
    Single quotes are not JSON. A field of the wrong type makes the whole text malformed.
    """
    wrapped = T.StructType(
        [
            T.StructField("body", schema),
            T.StructField("_end", T.IntegerType()),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
    }
    whole = F.from_json(F.concat(F.lit('{"body":'), text, F.lit(',"_end":1}')), wrapped, options)
    made = with_computed_once(rows, "_json", whole)
    sound = (F.col("_json._end") == 1) & F.col(f"_json.{_CORRUPT}").isNull()
    return made.withColumn(name, F.when(sound, F.col("_json.body"))).drop("_json")
