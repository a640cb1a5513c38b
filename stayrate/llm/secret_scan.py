"""Secrets in texts: patterns of known kinds, and stretches of high entropy. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the patterns of the base kinds ---------------------------
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
# ----------------------------------------------------------------------------

#: Runs that may be a random string.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Strings with three slashes: paths, but long base64 has them too.
PATH = r"/[^/]*/[^/]*/"
#: A candidate is read in stretches of so many characters, so that memory for it stays bounded.
STRETCH = 4096
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]


@dataclass(frozen=True)
class Entropy:
    """When a candidate string counts as random.

    A window of `width` characters slides over the candidate. Each window is judged by the class of
    its own characters: hexadecimal, other strings with letters of one case (base32, lower case and
    digits), and mixed ones. It is hot if it holds `digits` digits and a letter, and its Shannon entropy
    in bits a character reaches the bound of the class. Bounds lie where about nine of ten random strings
    of 24 characters of the class have a hot window. A string with three slashes is taken for a path
    unless a hot window lies between two of its slashes. Candidates that an allow-list
    pattern matches (placeholders, counting sequences, UUIDs) are none.
    """

    width: int = 20
    digits: int = 2
    hex_bits: float = 3.1
    one_case_bits: float = 3.55
    mixed_bits: float = 3.7
    allow: list[str] = field(
        default_factory=lambda: [
            r"(?i)example|sample|placeholder|changeme|dummy|xxxxxx",
            r"(?i)0123456789|abcdefghij|qwertyuiop",
            r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
        ]
    )


def _found(text: Column, pattern: str, keep, parts: Column | None = None) -> Column:
    """Spans (start, end, match) of the leftmost non-overlapping matches that `keep` accepts.

    The gaps around all matches, as split by the pattern, and the matches themselves have the
    lengths from which the places follow. Patterns never match an empty string.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = matches if parts is None else parts
    pieces = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"), parts.alias("part")
    )
    span = "struct<start:int,end:int,match:string>"

    def add(so_far: Column, piece: Column) -> Column:
        start = so_far["at"] + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match")).cast(span))
        spans = F.when(keep(piece["part"]), F.concat(so_far["spans"], one)).otherwise(so_far["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    nothing = F.array().cast(f"array<{span}>")
    total = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), add, lambda x: x["spans"])
    return F.when(text.rlike(pattern), total).otherwise(nothing)


def _characters(text: Column) -> Column:
    """For each character: the long and the byte in it that hold its count, and its class."""

    def of(char: Column) -> Column:
        code = F.ascii(char)
        place = code - F.lit(40)
        digit, upper, lower = code.between(48, 57), code.between(65, 90), code.between(97, 122)
        return F.struct(
            code.alias("code"),
            F.floor(place / 8).cast("int").alias("word"),
            F.pmod(place, F.lit(8)).alias("byte"),
            digit.cast("int").alias("digit"),
            upper.cast("int").alias("upper"),
            lower.cast("int").alias("lower"),
            (~(digit | code.between(65, 70) | code.between(97, 102))).cast("int").alias("beyond"),
            (code == 47).cast("int").alias("slash"),
        )

    return F.transform(F.split(text, ""), of)


_TALLIES = ["digit", "upper", "lower", "beyond", "slash"]
_WORDS = 11  # of eight counts each, for the characters from ( to DEL


def hot_stretch(match: Column, entropy: Entropy) -> Column:
    """(first, last, inside): the 1-based end positions of the first and last hot window, 0 without one, and whether
    a hot window holds no slash.

    Counts for each character, eight to a long, tallies for each class and the sum of c log2 c are carried from window
    to window: the character that comes in and the one that goes change one count and one term each. The sum
    is kept in billionths as a whole number, so a window's entropy does not depend on where it stands.
    The match is read in stretches, each with the `width` characters before it, so time is linear.
    """
    width, scale = entropy.width, 10**9
    if not 1 < width < 127:
        raise ValueError("a window has 2 to 126 characters")
    term = [0 if c < 2 else round(scale * c * math.log2(c)) for c in range(width + 2)]
    gain = F.array(*[F.lit(term[c + 1] - term[c]).cast("long") for c in range(width + 1)])
    units = F.array(*[F.lit(1 << (8 * k)).cast("long") for k in range(8)])

    def most(bits: float) -> Column:
        """The largest sum of c log2 c that a window of this entropy has."""
        return F.lit(math.floor(scale * width * (math.log2(width) - bits) + 0.5)).cast("long")

    def seen(state: Column) -> list[Column]:
        bound = (
            F.when(state["beyond"] == 0, most(entropy.hex_bits))
            .when((state["upper"] > 0) & (state["lower"] > 0), most(entropy.mixed_bits))
            .otherwise(most(entropy.one_case_bits))
        )
        hot = (
            (state["at"] >= width)
            & (state["sum"] <= bound)
            & (state["digit"] >= entropy.digits)
            & (state["upper"] + state["lower"] > 0)
        )
        return [
            F.when((state["first"] == 0) & hot, state["at"]).otherwise(state["first"]).alias("first"),
            F.when(hot, state["at"]).otherwise(state["last"]).alias("last"),
            (state["inside"] | ((state["slash"] == 0) & hot)).alias("inside"),
        ]

    def slide(state: Column, step: Column) -> Column:
        comes, goes = step["comes"], step["goes"]
        full = state["at"] >= width

        def count(x: Column) -> Column:
            word = F.element_at(state["counts"], x["word"] + 1)
            return F.call_function("shiftright", word, x["byte"] * 8).bitwiseAND(F.lit(255)).cast("int")

        added = F.element_at(units, comes["byte"] + 1)
        taken = F.element_at(units, goes["byte"] + 1)
        change = F.when(full & (comes["code"] == goes["code"]), F.lit(0).cast("long")).otherwise(
            F.element_at(gain, count(comes) + 1) - F.when(full, F.element_at(gain, count(goes))).otherwise(F.lit(0).cast("long"))
        )
        counts = F.transform(
            state["counts"],
            lambda w, k: w + F.when(k == comes["word"], added).otherwise(F.lit(0)) - F.when(full & (k == goes["word"]), taken).otherwise(F.lit(0)),
        )
        tallies = [(state[t] + comes[t] - F.when(full, goes[t]).otherwise(F.lit(0))).alias(t) for t in _TALLIES]
        return F.struct((state["at"] + 1).alias("at"), counts.alias("counts"), (state["sum"] + change).alias("sum"), *tallies, *seen(state))

    start = F.struct(
        F.lit(0).alias("at"), F.array_repeat(F.lit(0).cast("long"), _WORDS).alias("counts"), F.lit(0).cast("long").alias("sum"),
        *[F.lit(0).alias(t) for t in _TALLIES], F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(False).alias("inside"),
    )
    parts = F.regexp_extract_all(match, F.lit(f".{{1,{STRETCH}}}"), F.lit(0))
    # Before the first stretch stand characters that no window holds.
    before = F.concat(F.array(F.lit("(" * width)), F.transform(parts, lambda x: F.right(x, F.lit(width))))

    def through(state: Column, part: Column) -> Column:
        leaving = F.left(F.concat(part["before"], part["part"]), F.length(part["part"]))
        steps = F.arrays_zip(_characters(part["part"]).alias("comes"), _characters(leaving).alias("goes"))
        return F.aggregate(steps, state, slide)

    stretches = F.arrays_zip(F.slice(before, F.lit(1), F.size(parts)).alias("before"), parts.alias("part"))
    return F.aggregate(stretches, start, through, lambda state: F.struct(*seen(state)))


def _scanned(documents: DataFrame, entropy: Entropy) -> DataFrame:
    """row (the document), known (spans of the patterns) and spans (all of them, in order)."""
    text = F.col("text")
    # In a run of these classes only the longest match from the first start can be long enough.
    access = ACCESS.replace("+", f"{{{ACCESS_LENGTH - 4},}}")
    hexadecimal = HEX.replace("+", f"{{{HEX_LENGTH},}}")
    always = lambda part: F.lit(True)
    secret = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))

    def random_looking(part: Column) -> Column:
        keep = part.rlike("[0-9]") & part.rlike("[A-Za-z]")
        for pattern in entropy.allow:
            keep = keep & ~part.rlike(pattern)
        return keep

    base = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    ).select(
        "row",
        _found(text, ASSIGN, lambda part: F.length(part) >= ASSIGN_LENGTH, secret).alias("assign"),
        _found(text, access, always).alias("access"),
        _found(text, hexadecimal, always).alias("hex"),
        _found(text, CANDIDATE, random_looking).alias("candidates"),
    )

    def stretch(found: Column) -> Column:
        return F.struct(
            found["start"].alias("from"),
            hot_stretch(found["match"], entropy).alias("hot"),
            found["match"].rlike(PATH).alias("path"),
            F.when(found["match"].rlike("^[0-9a-fA-F]+$"), 3).otherwise(4).alias("kind"),
        )

    def placed(found: Column) -> Column:
        hot = found["hot"]
        taken = (hot["last"] > 0) & (~found["path"] | hot["inside"])
        return F.struct(
            (found["from"] + hot["first"] - entropy.width).cast("int").alias("start"),
            F.when(taken, found["from"] + hot["last"]).otherwise(F.lit(-1)).cast("int").alias("end"),
            found["kind"].alias("kind"),
        )

    def labelled(column: str, kind: int) -> Column:
        return F.transform(column, lambda x: F.struct(x["start"], x["end"], F.lit(kind).alias("kind")))

    known = base.select(
        "row",
        F.concat(labelled("assign", 0), labelled("access", 1), labelled("hex", 2)).alias("known"),
        F.transform(F.transform("candidates", stretch), placed).alias("stretches"),
    )
    new = F.filter(
        "stretches",
        lambda x: (x["end"] >= 0)
        & ~F.exists("known", lambda k: (k["start"] <= x["start"]) & (x["end"] <= k["end"])),
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.transform(F.concat("known", new), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    )

    return known.select(
        "row",
        "known",
        F.transform(
            ordered, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.element_at(kinds, x["kind"] + 1).alias("kind"))
        ).alias("spans"),
    )


def secret_spans(documents: DataFrame, entropy: Entropy | None = None) -> DataFrame:
    """Secrets in documents (doc_id, text) as spans in code points, end exclusive.

    Returns per document doc_id, n_assign, n_access, n_hex, and spans, an array of (start, end,
    kind) in order of start, then of kind as listed in KINDS. The first three kinds are
    patterns, found leftmost and without overlap each for itself. The others are the hot stretches
    of candidate strings (see Entropy), unless a pattern's span holds them already; the allow-list
    never takes away a pattern's span.

    Null and empty texts have no spans. Every row is handled by itself, repeated or not. A candidate of any length is
    read once, in stretches. Other columns are not read. Without documents there are no rows.
    """
    found = _scanned(documents.select("doc_id", "text"), entropy or Entropy())

    def count(kind: int) -> Column:
        return F.size(F.filter("known", lambda k: k["kind"] == kind)).cast("long")

    return found.select(
        "row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), "spans"
    )


def masked(documents: DataFrame, mark: str = "[secret]", entropy: Entropy | None = None) -> DataFrame:
    """The documents with every secret in `text` replaced by a mark; overlapping secrets get one mark.

    All columns stay, whatever their names; a null text stays null. Rows are handled where they are.
    """
    found = _scanned(documents, entropy or Entropy())
    text = F.col("row.text")

    def cut(so_far: Column, x: Column) -> Column:
        gap = F.substring(text, so_far["at"] + 1, F.greatest(x["start"] - so_far["at"], F.lit(0)))
        fresh = (x["start"] >= so_far["at"]) | (so_far["at"] == 0)
        return F.struct(
            F.greatest(so_far["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(so_far["text"], gap, F.lit(mark))).otherwise(so_far["text"]).alias("text"),
        )

    whole = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("text")),
        cut,
        lambda x: F.concat(x["text"], F.substring(text, x["at"] + 1, F.length(text))),
    )
    clean = F.when(F.size("spans") > 0, whole).otherwise(text)
    return found.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
