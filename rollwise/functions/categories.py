"""Assortment categories of an article code, decided by its first two characters.

The categories of order positions are disjoint. Each measure tests its own prefix list, inside its
aggregate: one expression for all categories would stand in the method that handles a row, which the
JVM runs uncompiled once it is longer than 8,000 bytes.
"""

from __future__ import annotations

# Two-character article prefixes per category.
PREFIXES = {
    "Schuh": ("21", "25"),
    "Haka": ("15", "16", "17", "18"),
    "Kika": ("22", "23", "24", "26"),
    "Wae": ("20", "33", "35", "36", "37"),
    "Bade": ("65", "66"),
    "Sport": ("34", "67", "73"),
    "Acc": ("76",),
    "Dob": (
        "11", "13", "27", "28", "51", "52", "53", "54", "55", "57", "58", "61", "62", "63", "64", "68",
        "69", "70", "71", "72", "74", "75", "78", "81", "82", "83", "84", "85", "86", "87", "88",
    ),
}
# Order positions put every code starting with this character into Tex; style views
# know only these home-textile prefixes instead.
TEX_FIRST_CHARACTER = "4"
HOME_PREFIXES = ("41", "42", "43", "45", "47", "48", "49")
# Fixed value: the maternity prefix, which also belongs to Dob.
MATERNITY_PREFIX = "53"
# Categories and further codes that can be a big size, and the big sizes.
BIG_SIZE_EXTRA_PREFIXES = ("20", "34", "35", "36", "37", "67", "73")
BIG_SIZE_CODES = (
    "331", "334", "335", "336", "651", "652", "653", "654", "656", "657", "658", "661", "662", "663",
    "664", "666", "667",
)
BIG_SIZES = ("48", "50", "52", "54", "56", "58", "60", "100", "105", "110", "115", "XL", "XXL", "XXXL")

# Categories counted for the assortment breadth.
CATEGORIES = ("Tex", *PREFIXES)


def _in(expr: str, values: tuple[str, ...]) -> str:
    return f"{expr} IN ({', '.join(repr(v) for v in values)})"


def _case(branches: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in branches.items())
    return f"CASE {arms} END"


def in_category_sql(prefix: str, name: str) -> str:
    """Whether an order position with this two-character prefix is of the category ``name``."""
    if name in PREFIXES:
        return _in(prefix, PREFIXES[name])
    return f"startswith({prefix}, '{TEX_FIRST_CHARACTER}')"


def style_category_sql(prefix: str) -> str:
    """Category of a viewed style by its two-character prefix."""
    branches = {name: _in(prefix, values) for name, values in PREFIXES.items()}
    branches["Wohnen"] = _in(prefix, HOME_PREFIXES)
    return _case(branches)


def big_size_sql(prefix: str, code: str, size: str) -> str:
    """True for a big size of an article that is sold in big sizes."""
    eligible = f"({_in(prefix, PREFIXES['Dob'] + BIG_SIZE_EXTRA_PREFIXES)} OR {_in(code, BIG_SIZE_CODES)})"
    return f"({eligible} AND {_in(size, BIG_SIZES)})"
