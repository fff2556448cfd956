from opinion_spark.functions.exprs import (  # noqa: F401
    safe_div,
    null_false,
    word_alternation,
    substring_alternation,
    WORD_CLASS,
    WS_CLASS,
    NONSPACE_CLASS,
)
