"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen (except
``fold_accents``, an Arrow-batched pandas UDF)."""

from tunelake.functions.casts import lenient_cast, parse_date  # noqa: F401
from tunelake.functions.hashing import hash_order_key, stable_bucket  # noqa: F401
from tunelake.functions.text import (  # noqa: F401
    fold_accents, normalise_country, normalise_name, remove_literal,
    song_key, squeeze_spaces, strip_special,
)
