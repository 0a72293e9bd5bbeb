"""Finding an element's end in markup, natively: tags of its name are counted.

SURVEY IDs: P1, P10 (element boundaries).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions.text import col_, let


def element_text(rest, tag: str | Column) -> Column:
    """The inside of an element: ``rest`` is the markup after its opening tag.

    Elements of the same name nest, so the end is the first closing tag at which as many
    have closed as have opened.  Without one the element goes on to the end of ``rest``.
    """
    name = F.lower(F.lit(tag) if isinstance(tag, str) else tag)
    # a blank in front keeps the first piece from being taken for a tag
    pieces = F.split(F.concat(F.lit(" "), col_(rest)), F.concat(F.lit("(?i)(?=</?"), name, F.lit("[\\s/>])")), -1)

    def step(name):
        def run(s, piece):
            head = F.lower(F.substring(piece, 1, 64))
            turn = (F.when(F.startswith(head, F.concat(F.lit("</"), name)), F.lit(-1))
                    .when(F.startswith(head, F.concat(F.lit("<"), name)), F.lit(1)).otherwise(F.lit(0)))
            depth = s["depth"] + turn
            return F.when((s["depth"] == 0) | (depth == 0), F.struct(F.lit(0).alias("depth"), s["n"].alias("n"))).otherwise(
                F.struct(depth.alias("depth"), (s["n"] + 1).alias("n")))
        return run

    def inside(p):
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        count = F.aggregate(p["pieces"], start, step(p["name"]), lambda s: s["n"])
        return F.substring(F.array_join(F.slice(p["pieces"], F.lit(1), count), ""), 2, 1 << 30)
    return let(F.struct(pieces.alias("pieces"), name.alias("name")), inside)


def elements(block, tag: str) -> Column:
    """Every element of a name in ``block``, nested ones too, in order: ``(open, inside)``."""
    pieces = F.split(col_(block), rf"(?i)(?=<{tag}[\s/>])", -1)
    opening = rf"(?is)^<{tag}\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"

    def all_of(p):
        starts = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.get(p, i - 1).rlike(opening))

        def one(i):
            head = F.regexp_extract(F.get(p, i - 1), opening, 0)
            rest = F.array_join(F.slice(p, i, F.size(p)), "")
            return F.struct(head.alias("open"), element_text(F.substring(rest, F.length(head) + 1, F.length(rest)), tag).alias("inside"))
        return F.transform(starts, one)
    return let(pieces, all_of)
