"""Token counting (K1, K5, K6) as Catalyst expressions.

The pre-tokeniser is a regular expression evaluated in the JVM
(``regexp_extract_all`` / ``regexp_count``), so counting stays inside whole-stage
code generation. BPE merging (K3/K4) lives in ``memweave.operators.bpe``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the published GPT-2 pre-tokeniser) ------------
# Whitespace class of the .NET ``\s``: Java's ``\s`` is ASCII-only, so the
# Unicode class is spelled out.
WS_CLASS = r"\f\n\r\t\x0B\x85\p{Z}"
# Pre-token pattern: contractions, optional space + letters, optional space +
# digits, optional space + other symbols, whitespace not followed by
# non-whitespace, remaining whitespace.
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WS_CLASS}\p{{L}}\p{{N}}]+|[{WS_CLASS}]+(?![^{WS_CLASS}])|[{WS_CLASS}]+"
)
# ---------------------------------------------------------------------------

WORD_PATTERN = rf"[^{WS_CLASS}]+"
COUNT_MODES = ("whitespace", "pretoken", "bpe")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretokens(text) -> Column:
    """K1: the pre-tokens of a text, in order (empty for NULL / empty text)."""
    text = _col(text)
    return F.coalesce(F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0), F.array().cast("array<string>"))


def words(text) -> Column:
    """Whitespace-separated words (Unicode whitespace)."""
    return F.coalesce(F.regexp_extract_all(_col(text), F.lit(WORD_PATTERN), 0), F.array().cast("array<string>"))


def count_tokens(text, mode: str = "pretoken") -> Column:
    """K5: token count of a text; NULL or empty text counts 0.

    ``whitespace`` counts words, ``pretoken`` counts pre-tokens. ``bpe`` needs a
    merge table and is a join, see ``memweave.operators.bpe.count_bpe_tokens``.
    """
    text = _col(text)
    if mode == "whitespace":
        pattern = WORD_PATTERN
    elif mode == "pretoken":
        pattern = PRETOKEN_PATTERN
    elif mode == "bpe":
        raise ValueError("bpe counting is a join: use memweave.operators.bpe.count_bpe_tokens")
    else:
        raise ValueError(f"count mode must be one of {COUNT_MODES}")
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("int")


def over_budget(n_tokens, max_tokens: int) -> Column:
    """K6: flag (not drop) texts above the model maximum."""
    return _col(n_tokens) > F.lit(max_tokens)
