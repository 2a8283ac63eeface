"""Column expressions; every one is a built-in Spark expression (codegen, no UDF)."""

from cityzones.functions.text import (  # noqa: F401
    ACCENTED,
    UNACCENTED,
    normalize_name,
    patch_quoted_comma,
    remove_char,
    split_fields,
    strip_char,
    strip_char_all,
)
from cityzones.functions.values import (  # noqa: F401
    null_fallback,
    surrogate_key,
    to_int,
    version_string,
)
from cityzones.functions.checks import fail_if, require_not_null  # noqa: F401
