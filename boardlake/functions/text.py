"""Text expressions: folding, tokens, truncation, lists and labels."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, digits and private-use code points form tokens; everything else separates them.
SEPARATORS = r"[^\p{L}\p{N}\p{Co}]+"
# A token of the original text: combining marks belong to the character before them.
RAW_TOKEN = r"[\p{L}\p{N}\p{Co}][\p{L}\p{N}\p{Co}\p{M}]*"
# White space including Unicode spaces and the byte-order mark.
SPACE = r"[\s\p{Z}\x{FEFF}]+"


@functools.lru_cache(maxsize=1)
def accent_pairs() -> tuple[str, str]:
    """Accented letters of the basic plane and their base letters, derived from Unicode decompositions."""
    accented, base = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if not unicodedata.category(char).startswith("L"):
            continue
        decomposed = unicodedata.normalize("NFD", char)
        if len(decomposed) > 1 and all(unicodedata.category(c).startswith("M") for c in decomposed[1:]):
            accented.append(char)
            base.append(decomposed[0])
    return "".join(accented), "".join(base)


def fold(text: Column) -> Column:
    """Lower case without diacritics. Plain ASCII skips the character map."""
    lowered = F.lower(text)
    accented, base = accent_pairs()
    stripped = F.regexp_replace(F.translate(lowered, accented, base), r"\p{M}+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), stripped).otherwise(lowered)


def tokenize(text: Column) -> Column:
    """Folded tokens in order; NULL text has none."""
    parts = F.split(fold(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends."""
    return F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")


def truncate(text: Column, width: int) -> Column:
    """One line of at most ``width`` characters, cut with an ellipsis."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    cut = F.concat(F.substring(flat, 1, max(0, width - 1)), F.lit("…"))
    return F.when(F.length(flat) > width, cut).otherwise(flat)


def csv_split(text: Column) -> Column:
    """Comma list: items trimmed, blank ones dropped."""
    return F.array_remove(F.transform(F.split(text, ","), strip), "")


def strip_slashes(url: Column) -> Column:
    return F.regexp_replace(strip(url), "/+$", "")


def label(text: Column) -> Column:
    """First letter upper case, the rest untouched."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 2**31 - 1))


def author_label(name: Column, agent_id: Column, user_id: Column, kind: Column) -> Column:
    return F.coalesce(name, agent_id, user_id, kind, F.lit("?"))


def assignee_label(name: Column, agent_id: Column) -> Column:
    """Agent name, else the first eight characters of its id, else blank."""
    return F.coalesce(name, F.substring(agent_id, 1, 8), F.lit(""))
