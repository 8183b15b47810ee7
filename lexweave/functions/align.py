"""Whether, and how, a reading can be dealt to the characters of a spelling.

The reading table is a plain dict from a character to (on, kun) readings, small
enough to go to every task. What a character may sound like at its place comes
from two tables: endings that a native reading may lose or change where its
okurigana isn't written, and changes of the first and last kana of a part.

The search fills one set for each character, from the last to the first: the
places of the reading from which the rest can be dealt. Its cost is bounded by
the product of the two lengths, and nothing recurses. The first way is then
read off from the front.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import functions as F

from lexweave.functions.kana import H_HALF, H_PLAIN, PLAIN, ROW_I, ROW_U, VOICED

Readings = Mapping[str, tuple[Iterable[str], Iterable[str]]]

#: Particles that a spelling leaves out; marks that repeat the character before.
PARTICLES = ("の", "つ", "が")
REPEATS = "々〻"
#: Last kana that double before another part.
DOUBLING = "つくちき"

#: By last kana of a native reading: what may stand instead where okurigana isn't written; and whether only at the last character.
ENDINGS: dict[str, list[tuple[str, bool]]] = {
    u: [("", False)] * (u == "る") + [(i, False)] * (i != "　") + [("", True)] for u, i in reversed(list(zip(ROW_U, ROW_I, strict=True)))
}
#: By first kana: what it becomes after another part.
VOICING: dict[str, str] = {}
for _plain, _changed in ((PLAIN, VOICED), (H_PLAIN, H_HALF)):
    for _a, _b in zip(_plain, _changed, strict=True):
        VOICING[_a] = VOICING.get(_a, "") + _b

_TO_HIRAGANA = {chr(c + 0x60): chr(c) for c in range(0x3041, 0x3097)}


def written_forms(kun: str, last: bool) -> list[str]:
    """A native reading as a character alone may stand for it: whole, its first half and more, or with its ending changed."""
    halves = [kun[:n] for n in range(max(2, (len(kun) + 1) // 2), len(kun))]
    changed = [kun[:-1] + end for end, only_last in ENDINGS.get(kun[-1:], ()) if len(kun) > 1 and (last or not only_last)]
    return [kun, *halves, *changed]


def sounds(reading: str, first: bool, last: bool, voicing: bool) -> list[str]:
    """A reading as it may sound at its place: voiced after another part, doubled before one."""
    voiced = "" if first or not voicing else VOICING.get(reading[:1], "")
    doubled = [reading[:-1] + "っ"] if reading[-1:] and reading[-1] in DOUBLING and not last else []
    return [reading, *(c + reading[1:] for c in voiced), *doubled]


def is_kana(ch: str) -> bool:
    return ch in _TO_HIRAGANA or ch in VOICING or "ぁ" <= ch <= "ゖ"


class Aligner:
    """voicing: whether a later part may be voiced; last_kun: whether the last character takes native readings only."""

    def __init__(self, readings: Readings, voicing: bool = True, last_kun: bool = False) -> None:
        self.readings, self.voicing, self.last_kun = readings, voicing, last_kun
        self._sounds: dict[tuple[str, bool, bool], tuple[str, ...]] = {}

    def _of(self, ch: str, first: bool, last: bool) -> tuple[str, ...]:
        """What a character may sound like, made once for each kind of place."""
        key = (ch, first, last)
        if key not in self._sounds:
            on, kun = self.readings.get(ch, ((), ()))
            native = last and self.last_kun
            forms = dict.fromkeys([*(() if native else on), *(x for k in kun for x in written_forms(k, native))])
            self._sounds[key] = tuple(dict.fromkeys(s for f in forms for s in sounds(f, first, last, self.voicing) if s))
        return self._sounds[key]

    def _places(self, spelling: str) -> list[tuple[str, ...]]:
        """Sounds by character; a repeat mark has those of the character before it, kana sound like themselves."""
        out, source, end = [], "", len(spelling) - 1
        for i, ch in enumerate(spelling):
            source = source if ch in REPEATS else "" if is_kana(ch) else ch
            if is_kana(ch):
                out.append((_TO_HIRAGANA.get(ch, ch),))
            elif ch in REPEATS and self.last_kun and i == end and source:
                # a mark takes the readings that its character has where it stands
                on, kun = self.readings.get(source, ((), ()))
                forms = dict.fromkeys([*on, *(x for k in kun for x in written_forms(k, False))])
                out.append(tuple(dict.fromkeys(s for f in forms for s in sounds(f, i == 0, True, self.voicing) if s)))
            else:
                out.append(self._of(source, i == 0, i == end))
        return out

    def segment(self, spelling: str, reading: str, most_left: int = 0) -> list[tuple[str, str]] | None:
        """(character, its part) for each character, the first way in reading order; None if there is none.

        most_left: kana that may be left over. A particle that isn't written
        belongs to no character.
        """
        places, n = self._places(spelling), len(reading)
        rest = set(range(max(0, n - most_left), n + 1))
        own: list[set[int]] = []  # by character from the last on: where its part may begin
        after: list[set[int]] = []  # and where what follows it may
        for i in range(len(places) - 1, -1, -1):
            own.append({j for j in range(n) if any(j + len(v) in rest and reading.startswith(v, j) for v in places[i])})
            after.append(rest)
            rest = own[-1] | (_before(reading, own[-1]) if i and not is_kana(spelling[i]) else set())
        if 0 not in rest:
            return None
        out, at = [], 0
        for ch, values, starts, ends in zip(spelling, places, reversed(own), reversed(after), strict=True):
            if at not in starts:
                at += next(len(p) for p in PARTICLES if reading.startswith(p, at) and at + len(p) in starts)
            part = next(v for v in values if reading.startswith(v, at) and at + len(v) in ends)
            out.append((ch, part))
            at += len(part)
        return out

    def fits(self, spelling: str, reading: str, most_left: int = 0) -> bool:
        return self.segment(spelling, reading, most_left) is not None


def _before(reading: str, starts: set[int]) -> set[int]:
    """Where a particle stands just before one of the starts."""
    return {j - len(p) for j in starts for p in PARTICLES if j >= len(p) and reading.startswith(p, j - len(p))}


def once(fit, *columns: pd.Series) -> list:
    """fit of each row's values, computed once for equal rows; null where one of the first two is."""
    seen: dict[tuple, object] = {}
    out = []
    for row in zip(*columns, strict=True):
        if row[0] is None or row[1] is None:
            out.append(None)
            continue
        if row not in seen:
            seen[row] = fit(*row)
        out.append(seen[row])
    return out


def fits_udf(readings: Readings, most_left: int = 1, **options):
    """Arrow UDF (spelling, reading) -> boolean; null where either is."""
    aligner = Aligner(readings, **options)

    @F.pandas_udf("boolean")
    def fits(spelling: pd.Series, reading: pd.Series) -> pd.Series:
        return pd.Series(once(lambda a, b: aligner.fits(a, b, most_left), spelling, reading), dtype="boolean")

    return fits


def segment_udf(readings: Readings, most_left: int = 0, **options):
    """Arrow UDF (spelling, reading) -> array<struct<ch, kana>>; null where it doesn't fit."""
    aligner = Aligner(readings, **options)

    @F.pandas_udf("array<struct<ch: string, kana: string>>")
    def segment(spelling: pd.Series, reading: pd.Series) -> pd.Series:
        rows = once(lambda a, b: aligner.segment(a, b, most_left), spelling, reading)
        return pd.Series([None if r is None else [{"ch": c, "kana": k} for c, k in r] for r in rows])

    return segment
