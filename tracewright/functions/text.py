"""Text as columns: redaction, chunking, literal replacement, keyword counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, in the order they apply: name, pattern, placeholder.
REDACTIONS = (
    ("EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL_REDACTED]"),
    ("GENERIC_API_KEY", r"\b((sk|pk|rk)-[a-zA-Z0-9]{20,})\b", "[API_KEY_REDACTED]"),
    ("HF_TOKEN", r"\b(hf_[a-zA-Z0-9]{30,})\b", "[HF_TOKEN_REDACTED]"),
    ("GITHUB_TOKEN", r"\b(ghp_[a-zA-Z0-9]{30,}|gho_[a-zA-Z0-9]{30,}|ghu_[a-zA-Z0-9]{30,}|ghs_[a-zA-Z0-9]{30,}|ghr_[a-zA-Z0-9]{30,})\b", "[GITHUB_TOKEN_REDACTED]"),
    ("AWS_ACCESS_KEY_ID", r"\b(AKIA[0-9A-Z]{16})\b", "[AWS_ACCESS_KEY_ID_REDACTED]"),
    ("POTENTIAL_AWS_SECRET_KEY", r"\b([A-Za-z0-9/+=]{40})\b", "[POTENTIAL_SECRET_KEY_REDACTED]"),
    ("JWT", r"\b(ey[A-Za-z0-9-_=]+\.[A-Za-z0-9-_=]+\.[A-Za-z0-9-_.+/=]+)\b", "[JWT_REDACTED]"),
    ("URL_CREDENTIALS", r"https?://(?:[^:]+:[^@]+@)", "[URL_CREDENTIALS_REDACTED_PREFIX]"),
    ("CREDIT_CARD", r"\b(?:\d{4}[- ]?){3}\d{4}\b", "[CREDIT_CARD_REDACTED]"),
    ("PHONE_NUMBER", r"\b(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}\b", "[PHONE_NUMBER_REDACTED]"),
    ("IP_ADDRESS_V4", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", "[IP_ADDRESS_REDACTED]"),
)

#: What a text must hold for a rule to match at all; looked for before the pattern is.
NEEDS = {"EMAIL": "@", "GENERIC_API_KEY": "k-", "HF_TOKEN": "hf_", "GITHUB_TOKEN": "gh", "AWS_ACCESS_KEY_ID": "AKIA", "JWT": "ey", "URL_CREDENTIALS": "://", "IP_ADDRESS_V4": "."}

#: Words that make a trace look complex.
COMPLEXITY_KEYWORDS = (
    "explain", "debug", "code", "implement", "algorithm", "complex", "step-by-step", "error", "fix", "troubleshoot",
    "analyze", "refactor", "optimize", "integrate", "configure", "deploy", "architecture", "database", "security", "performance",
)


def redact(text: Column, rules=REDACTIONS) -> Column:
    """struct(text, found): each rule applied to what the ones before left, and the names of those that changed it.

    Classes and word boundaries are Unicode's.  A null text stays null and has no findings.
    """
    state = F.struct(text.alias("text"), F.expr("cast(array() as array<string>)").alias("found"))
    for name, pattern, placeholder in rules:
        state = _let(state, _apply(name, pattern, placeholder))
    return state


def replaced(text: Column, name: str, pattern: str, placeholder: str) -> Column:
    """A rule applied to a text; texts without what its pattern cannot do without are passed by."""
    new = F.regexp_replace(text, "(?U)" + pattern, placeholder.replace("\\", "\\\\").replace("$", "\\$"))
    return F.when(F.contains(text, F.lit(NEEDS[name])), new).otherwise(text) if (name, pattern) in _NEEDED else new


_NEEDED = {(name, pattern) for name, pattern, _ in REDACTIONS if name in NEEDS}


def _apply(name: str, pattern: str, placeholder: str):
    """One rule as a function of the state so far."""

    def rule(s: Column) -> Column:
        def changed(new: Column) -> Column:
            found = F.when(new != s["text"], F.array_append(s["found"], F.lit(name))).otherwise(s["found"])
            return F.struct(new.alias("text"), found.alias("found"))

        return _let(replaced(s["text"], name, pattern, placeholder), changed)

    return rule


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(text: Column, size: int, overlap: int) -> Column:
    """Overlapping pieces of ``size`` code points; none of an empty or null text, the whole if size <= overlap."""
    none = F.expr("cast(array() as array<string>)")
    if size <= overlap:
        return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, none).otherwise(F.array(text))
    step = size - overlap
    n = F.length(text)
    last = F.ceil((n - size) / step) if overlap >= 0 else F.ceil(n / step) - 1
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), last).cast("int"))
    return F.when(F.coalesce(n, F.lit(0)) == 0, none).otherwise(F.transform(places, lambda i: F.substring(text, i * step + 1, F.lit(size))))


def replace_items(text: Column, items: Column) -> Column:
    """Each item's value, longest first, replaced by its category's placeholder; empty values replace nothing.

    Values of equal length go by value, then category.
    """
    order = F.array_sort(
        F.filter(items, lambda x: F.length(x["value"]) > 0),
        lambda a, b: F.when(F.length(a["value"]) != F.length(b["value"]), F.length(b["value"]) - F.length(a["value"]))
        .when(a["value"] != b["value"], F.when(a["value"] < b["value"], -1).otherwise(1))
        .when(a["category"] != b["category"], F.when(a["category"] < b["category"], -1).otherwise(1))
        .otherwise(0),
    )
    return F.aggregate(F.coalesce(order, F.array()), text, lambda t, x: F.replace(t, x["value"], F.concat(F.lit("["), F.upper(x["category"]), F.lit("_REDACTED]"))))


def keyword_hits(text: Column, keywords=COMPLEXITY_KEYWORDS) -> Column:
    """Whole-word hits of any keyword, letters of either case."""
    if not keywords:
        return F.lit(0)
    return F.regexp_count(text, F.lit("(?iuU)\\b(?:" + "|".join(re.escape(k) for k in keywords) + ")\\b"))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
