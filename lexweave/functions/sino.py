"""Sino-Japanese readings, one for each character, over a given table (the rime tables themselves are outside data).

`historical` gives a character's readings in old spelling, `on` those of the
modern character table. A part of the reading fits a character if it is one of
its readings in old spelling, or spells like one of them today.

The reading is cut by layers: layer i holds the states (place, part before if
the next character repeats it) that the first i characters can reach, with the
parts that lead on. States that lead nowhere are taken out from the end, and
the first way is read off from the front.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
import regex
from pyspark.sql import functions as F

from lexweave.functions import align
from lexweave.functions.kana import H_HALF, H_PLAIN, PLAIN, ROW_O, VOICED, _unvoiced_table, spelling_variants

Table = Mapping[str, Iterable[str]]
LONGEST = 6
#: Kana that a doubled end may stand for.
DOUBLED = "つくちきふ"
_LARGE = str.maketrans("ゃゅょゎ", "やゆよわ")
_HAN = regex.compile(r"[\p{Han}々]+")
_FU = regex.compile(f"[^ふ]*[{ROW_O}]ふ")
#: By voicing setting and by whether the part before ends in n or doubled: first kana and what they may come from.
_FROM_VOICED, _FROM_HALF = dict(zip(VOICED, PLAIN, strict=True)), dict(zip(H_HALF, H_PLAIN, strict=True))
_HEADS = {
    ("any", False): _FROM_VOICED | _FROM_HALF, ("any", True): _FROM_VOICED | _FROM_HALF,
    ("nasal", False): {}, ("nasal", True): _FROM_VOICED | _FROM_HALF,
    ("none", False): {}, ("none", True): _FROM_HALF,
}


class Sino:
    """voicing: `any` place, after a `nasal` only, or `none` of the parts but the first."""

    def __init__(self, historical: Table, on: Table | None = None, voicing: str = "any") -> None:
        self.old = {c: {r.translate(_LARGE) for r in rs} for c, rs in historical.items()}
        self.now = {c: {v for r in rs for v in spelling_variants(r, True)} for c, rs in self.old.items()}
        for c, rs in (on or {}).items():
            self.now.setdefault(c, set()).update(rs)
        self.voicing = voicing
        self._today: dict[str, frozenset[str]] = {}

    def _spelled_today(self, part: str) -> frozenset[str]:
        if part not in self._today:
            self._today[part] = frozenset(spelling_variants(part, True))
        return self._today[part]

    def _has(self, ch: str, part: str) -> bool:
        return part in self.old.get(ch, ()) or not self._spelled_today(part).isdisjoint(self.now.get(ch, ()))

    def _roots(self, part: str, first: bool, last: bool, nasal: bool) -> set[str]:
        """What a part is without doubling at its end and voicing at its start."""
        ends = [part, *(part[:-1] + c for c in DOUBLED if part[-1] == "っ" and not last)]
        heads = {} if first else _HEADS[self.voicing, nasal]
        return {*ends, *(heads[e[0]] + e[1:] for e in ends if e[0] in heads)}

    def segment(self, spelling: str, reading: str) -> list[str] | None:
        """The part of each character, the shortest first parts first; None if there is no way."""
        if not _HAN.fullmatch(spelling):
            return None
        text, end = "".join(c for c in reading if c not in "-ー・"), len(spelling) - 1
        state = (0, "")
        layers: list[dict[tuple[int, str], list[tuple[str, tuple[int, str]]]]] = []
        reached = {state: None}
        for i, ch in enumerate(spelling):
            layer = {}
            for at, before in reached:
                nasal = at > 0 and text[at - 1] in "んっ"
                ways = []
                for n in range(1, min(LONGEST, len(text) - at) + 1):
                    read = text[at : at + n]
                    # くあ stands for くわ
                    for part in (read, read[0] + "わ" + read[2:]) if read[:2] in ("くあ", "ぐあ") else (read,):
                        roots = self._roots(part.translate(_LARGE), i == 0, i == end, nasal)
                        wanted = {before, before.removesuffix("っ")}
                        if (not roots.isdisjoint(wanted)) if ch in align.REPEATS else any(self._has(ch, r) for r in roots):
                            ways.append((part, (at + n, part.translate(_LARGE) if i < end and spelling[i + 1] in align.REPEATS else "")))
                layer[at, before] = ways
            layers.append(layer)
            reached = dict.fromkeys(s for ways in layer.values() for _, s in ways)
        alive = {s for s in reached if s[0] == len(text)}
        for layer in reversed(layers):
            for s in layer:
                layer[s] = [w for w in layer[s] if w[1] in alive]
            alive = {s for s, ways in layer.items() if ways}
        if state not in alive:
            return None
        out = []
        for layer in layers:
            part, state = layer[state][0]
            out.append(part)
        return out

    def match(self, spelling: str, reading: str) -> tuple[str, str] | None:
        """(modern reading, the reading with its spelling put right), part by part."""
        parts = self.segment(spelling, reading)
        if parts is None:
            return None
        # a final fu of one character's reading is long, after o too
        usual = [(p, spelling_variants(p.replace("ゎ", "わ"), True)[0]) for p in parts]
        modern = "".join(m[:-1] + "う" if m[-1:] == "ふ" and _FU.fullmatch(p) else m for p, m in usual)
        fixed = iter("".join(parts))
        return modern, "".join(c if c in "-ー・" else next(fixed) for c in reading)


def sino_udf(sino: Sino):
    """Arrow UDF (spelling, reading) -> struct(modern, reading), null fields where it doesn't fit."""

    @F.pandas_udf("struct<modern: string, reading: string>")
    def match(spelling: pd.Series, reading: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([m or (None, None) for m in align.once(sino.match, spelling, reading)], columns=["modern", "reading"])

    return match


def refuted_udf(sino: Sino, readings: align.Readings):
    """Arrow UDF (spelling, reading) -> whether neither the Sino-Japanese nor any other reading of the characters fits."""
    a = align.Aligner(readings)

    def one(s: str, r: str) -> bool:
        if not _HAN.fullmatch(s):
            return True
        return sino.match(s, r) is None and not any(a.fits(s, v, 1 if len(s) == 1 else 0) for v in spelling_variants(r, True))

    @F.pandas_udf("boolean")
    def refuted(spelling: pd.Series, reading: pd.Series) -> pd.Series:
        return pd.Series(align.once(one, spelling.where(spelling.notna(), ""), reading), dtype="boolean")

    return refuted


#: Kana that h-row ones softened to inside a word.
_TWINS = {"わ": "は", "い": "ひ", "う": "ふ", "え": "へ", "お": "ほ"}


def without_h_twins(readings: align.Readings) -> dict[str, tuple[list[str], list[str]]]:
    """Native readings whose first kana is an h-row one that softened go, where the character has the h-row reading too."""
    out = {}
    for ch, (on, kun) in readings.items():
        every = {*on, *kun}
        out[ch] = (list(on), [k for k in kun if not (k[:1] in _TWINS and _TWINS[k[0]] + k[1:] in every)])
    return out


#: Kana with a voicing mark to those without.
_PLAIN = str.maketrans(*_unvoiced_table())


def aligned_with_learned(spelling: str, modern: str, historical: str, own: align.Aligner, learned: align.Aligner, most_left: int = 0) -> bool:
    """Alignment with learned readings, refused where a character that needs one covers a place that modern spelling changed."""
    parts = learned.segment(spelling, modern, most_left)
    if parts is None:
        return False
    same_length = len(historical) == len(modern)
    changed = {i for i, (a, b) in enumerate(zip(historical, modern, strict=same_length)) if a != b} if same_length else set(range(len(modern)))
    covered, at = set(), 0
    for ch, part in parts:
        known = {part, part[:1].translate(_PLAIN) + part[1:]}
        known |= {k[:-1] + c for k in known if k.endswith("っ") for c in align.DOUBLING}
        if _HAN.fullmatch(ch) and not any(own.fits(ch, k) for k in known):
            covered |= set(range(at, at + len(part)))
        at += len(part)
    return changed.isdisjoint(covered)
