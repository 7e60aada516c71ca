"""Column expressions over text: tokens and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token ends at any of the 29 white space characters of Unicode
# and ASCII. Java's \s knows only six of them.
TOKEN_BREAK = r"[\s\x1c-\x1f\x85\p{Z}]+"


def tokens(text: Column | str) -> Column:
    """Every token of ``text`` in order, case and punctuation kept."""
    return F.array_remove(F.split(text, TOKEN_BREAK), "")


def distinct_tokens(text: Column | str) -> Column:
    """The distinct tokens of ``text`` in order of first occurrence.

    The document-level dedup happens inside the row, so it needs no shuffle.
    """
    return F.array_remove(F.array_distinct(F.split(text, TOKEN_BREAK)), "")


def document_path(block: Column | str = "block", name: Column | str = "name") -> Column:
    return F.concat_ws("/", block, name)


def normal_path(path: Column | str) -> Column:
    """``path`` with ``/`` separators and without empty, ``.`` and inner ``..`` parts.

    Two leading slashes stay two, as POSIX asks; an empty path becomes ``.``.
    """
    slashed = F.translate(path, "\\", "/")
    rooted = slashed.startswith("/")
    kept = F.filter(F.split(slashed, "/"), lambda part: ~part.isin("", "."))

    def step(done: Column, part: Column) -> Column:
        goes_up = part == ".."
        can_drop = (F.size(done) > 0) & (F.element_at(done, -1) != "..")
        return (
            F.when(~goes_up, F.array_append(done, part))
            .when(F.size(done) == 0, F.when(rooted, done).otherwise(F.array_append(done, part)))
            .when(can_drop, F.slice(done, F.lit(1), F.size(done) - 1))
            .otherwise(F.array_append(done, part))
        )

    parts = F.aggregate(kept, F.array().cast("array<string>"), step)
    root = (
        F.when(slashed.rlike("^//(?!/)"), "//").when(rooted, "/").otherwise("")
    )
    joined = F.concat(root, F.array_join(parts, "/"))
    return F.when(joined == "", ".").otherwise(joined)
