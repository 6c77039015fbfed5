"""Text rules: search scores, snippets, cache keys, routing, compression, tool calls, redaction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that send a question to the capable model (matched as substrings).
COMPLEX_KEYWORDS = [
    "compare", "analyze", "why", "how does", "explain", "summarize", "breakdown", "calculate", "what's the difference",
    "step by step", "trade-off", "tradeoff", "pros and cons", "vs",
]
# The keyword list of rules B.
COMPLEX_KEYWORDS_B = [
    "compare", "analyze", "why", "how does", "explain", "summarize", "breakdown", "calculate", "trade-off", "tradeoff",
    "pros and cons", "step by step",
]
CAPABLE_MODEL = "gemini-2.5-flash"
CHEAP_MODEL = "gemini-2.5-flash-lite"

REDACTED = "[REDACTED]"
ANSWER_LOG_CHARS = 500
SPACE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Removes all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, SPACE, "")


def occurrences(text: Column, word: Column) -> Column:
    """Non-overlapping occurrences of ``word``."""
    return ((F.length(text) - F.length(F.replace(text, word, F.lit("")))) / F.length(word)).cast("bigint")


def match_score(title: Column, content: Column, word: Column) -> Column:
    """Three points per hit in the title, one per hit in the content, all in lower case."""
    return occurrences(title, word) * 3 + occurrences(content, word)


def snippet(content: Column, lowered: Column, word: Column, before: int = 80, after: int = 300) -> Column:
    """Text around the first hit, or the start of the content when only the title matched."""
    hit = F.instr(lowered, word)
    start = F.greatest(hit - before, F.lit(1))
    around = strip(F.substring(content, start, hit + after - start))
    return F.when(hit > 0, around).otherwise(F.substring(content, 1, after))


def opening(content: Column, chars: int = 500) -> Column:
    """First characters on one line."""
    return F.replace(F.substring(content, 1, chars), F.lit("\n"), F.lit(" "))


def cache_key(query: Column) -> Column:
    return F.lower(strip(query))


def is_complex(query: Column, keywords: list[str] | None = None) -> Column:
    q = F.lower(F.coalesce(query, F.lit("")))
    words = F.array(*[F.lit(k) for k in (keywords or COMPLEX_KEYWORDS)])
    return F.exists(words, lambda k: F.contains(q, k))


def route_model(query: Column, keywords: list[str] | None = None) -> Column:
    return F.when(is_complex(query, keywords), CAPABLE_MODEL).otherwise(CHEAP_MODEL)


def compress(answer: Column, max_chars: int = 1000) -> Column:
    """Cuts a long answer and says how many characters went (the marker is a fixed value); NULL becomes ''."""
    over = F.length(answer) - max_chars
    marker = F.concat(F.lit("\n[...compressed: "), over.cast("string"), F.lit(" chars truncated...]"))
    short = F.concat(F.substring(answer, 1, max_chars), marker)
    return F.when(answer.isNull(), "").when(over > 0, short).otherwise(answer)


def chars_saved(answer: Column, max_chars: int = 1000) -> Column:
    return F.greatest(F.coalesce(F.length(answer), F.lit(0)) - max_chars, F.lit(0))


def tool_name(text: Column) -> Column:
    """Tool named by a ``TOOL: name`` line, NULL if there is none."""
    return F.nullif(F.regexp_extract(text, r"TOOL:\s*([a-zA-Z_]+)", 1), F.lit(""))


def tool_args(text: Column) -> Column:
    """Map of the ``ARGS: key=value, key=value`` line; parts without '=' are skipped, the last of equal keys wins."""
    line = F.regexp_extract(text, r"ARGS:\s*(.+)", 1)
    pairs = F.filter(F.split(line, ","), lambda p: F.contains(p, F.lit("=")))
    keys = F.transform(pairs, lambda p: strip(F.substring_index(p, "=", 1)))
    values = F.transform(pairs, lambda p: strip(F.substring(p, F.instr(p, "=") + 1, F.length(p))))
    entries = F.arrays_zip(keys.alias("k"), values.alias("v"))
    n = F.size(entries)
    last = F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda l: l["k"] == e["k"])
    )
    return F.map_from_entries(last)


def _fold(role: Column, text: Column, hidden: dict[str, list[str]], rules) -> Column:
    """Applies the replacements of every role's hidden fields, in policy order."""
    out = None
    for name, fields in hidden.items():
        redacted = text
        for field in fields:
            for pattern, replacement in rules(field):
                redacted = F.regexp_replace(redacted, pattern, replacement)
        case = (role == name, redacted)
        out = F.when(*case) if out is None else out.when(*case)
    return text if out is None else out


# The patterns that redaction has to match, with FIELD for the field's name: a quoted key and its JSON value, a name and the word
# after its colon, and a name in prose with an optional linking word and a number or word. Only the first is adapted: its inner
# repetition is possessive, which matches the same and keeps Java's matcher from recursing over long strings.
JSON_FIELD = r'"FIELD"\s*:\s*("(?:[^"\\]|\\.)*+"|[^,}\n]+)'
LINE_FIELD = r"(^|\W)FIELD\s*:\s*([^\s,]+)"
PROSE_FIELD = r"(FIELD)(?:\s*(?:is|was|of|=|:|are|equals)?\s*)(\$?[\d][\d,\.\-x]*|\S+)"


def _quoted(replacement: str) -> str:
    """A replacement text in which no character refers to a group."""
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def _json_rules(field: str) -> list[tuple[str, str]]:
    """The field as a quoted JSON key, and as a word in front of a colon."""
    name = re.escape(field)
    return [
        ("(?U)" + JSON_FIELD.replace("FIELD", name), _quoted(f'"{field}": "{REDACTED}"')),
        ("(?Um)" + LINE_FIELD.replace("FIELD", name), "$1" + _quoted(f"{field}: {REDACTED}")),
    ]


def _prose_rules(field: str) -> list[tuple[str, str]]:
    """The field in any case; it keeps its spelling."""
    return [("(?Ui)" + PROSE_FIELD.replace("FIELD", re.escape(field)), f"$1: {REDACTED}")]


def redact_json(role: Column, text: Column, hidden: dict[str, list[str]], otherwise: list[str]) -> Column:
    """Hides ``"field": value`` and ``field: value`` of fields the role may not see.

    ``hidden`` maps each known role to its hidden fields; ``otherwise`` applies to unknown roles.
    """
    return F.coalesce(_fold(role, text, hidden, _json_rules), _fold(F.lit("*"), text, {"*": otherwise}, _json_rules))


def redact_prose(role: Column, text: Column, hidden: dict[str, list[str]], otherwise: list[str]) -> Column:
    """Hides ``field is value`` and its variants, ignoring case."""
    return F.coalesce(_fold(role, text, hidden, _prose_rules), _fold(F.lit("*"), text, {"*": otherwise}, _prose_rules))
