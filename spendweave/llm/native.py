"""SQL expressions that the native operators share. None of them runs Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters of a word.
WORD = r"[^\x20\x09-\x0D]+"

SPANS = "array<struct<start:int,kind_no:int,stop:int,kind:string,hit:string>>"


def text_of(column: str = "text") -> Column:
    """A text column without nulls."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def running(values: str, combine: str) -> str:
    """SQL for the running combination of an array, by doubling: each pass reaches twice as far back.

    ``combine`` joins ``v`` with the earlier ``w``. Work is n log n, and no array grows by single elements.
    """
    return f"""aggregate(filter(sequence(0, 30), k -> shiftleft(1, k) < size({values})), {values},
      (a, k) -> transform(a, (v, i) -> CASE WHEN i < shiftleft(1, k) THEN v
        ELSE transform(array(a[i - shiftleft(1, k)]), w -> {combine})[0] END))"""


def spans(text: str, kind: str, kind_no: int, pattern: str, keep: str) -> str:
    """SQL for the matches of ``pattern`` in ``text``: leftmost, not overlapping, then filtered.

    ``keep`` is a condition on ``s.hit``. Matches, and the gaps between them, come from the
    same scan of the regular-expression library, so that the running sums of their lengths are
    positions in code points. A text without a match is scanned once.
    """
    p = f"r'{pattern}'"
    return f"""transform(array(regexp_extract_all({text}, {p}, 0)), found ->
      CASE WHEN size(found) = 0 THEN cast(array() AS {SPANS}) ELSE filter(
        zip_with(found, transform(array(
            zip_with(found, slice(split({text}, {p}), 1, size(found)), (m, g) -> length(g) + length(m))
          ), lengths -> {running("lengths", "v + w")})[0],
          (m, stop) -> named_struct(
            'start', stop - length(m), 'kind_no', {kind_no}, 'stop', stop, 'kind', '{kind}', 'hit', m)),
        s -> {keep}) END)[0]"""


#: A text is cut into chunks of so many code points, since a place in a string is found by going there from its start.
CHUNK = 1024


def chunks(text: str) -> str:
    """SQL for a text as an array of chunks."""
    return f"regexp_extract_all({text}, r'(?s).{{1,{CHUNK}}}', 0)"


def piece(cut: str, start: str, stop: str) -> str:
    """SQL for the code points from ``start`` to before ``stop`` of a text in chunks; touches only its own chunks."""
    own = f"slice({cut}, {start} DIV {CHUNK} + 1, cast({stop} DIV {CHUNK} - {start} DIV {CHUNK} + 1 AS int))"
    return f"substring(array_join({own}, ''), {start} % {CHUNK} + 1, greatest({stop} - {start}, 0))"


def listed(found: str) -> str:
    """SQL for spans as text: kind:start:end, comma-joined, in the order of ``found``."""
    return f"array_join(transform({found}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
