"""Column-expression helpers (JVM-side, no Python UDFs)."""

from tabwatch.functions.columns import (  # noqa: F401
    bucketize,
    clip,
    ks_pvalue,
    safe_div,
    swap_values,
)
from tabwatch.functions.hashing import row_digest, uniform_hash, unit_hash  # noqa: F401
