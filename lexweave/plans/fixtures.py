"""What the queries over built fixtures share."""

from __future__ import annotations


def _values(rows, names: str) -> str:
    cell = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) v({names})"


#: A few characters' Sino-Japanese and native readings, for the alignment examples.
READINGS = {
    "足": (["そく"], ["あし", "たる"]), "場": (["じょう"], ["ば"]), "明": (["めい", "みょう"], ["あける", "あかるい"]), "方": (["ほう"], ["かた"]), "留": (["りゅう", "る"], ["とめる", "とまる"]), "愛": (["あい"], []),
    "國": (["こく"], ["くに"]), "牙": (["が"], ["きば"]), "飛": (["ひ"], ["とぶ"]), "出": (["しゅつ"], ["でる", "だす"]), "貝": (["ばい"], ["かい"]), "柱": (["ちゅう"], ["はしら"]), "學": (["がく"], ["まなぶ"]), "校": (["こう"], []), "時": (["じ"], ["とき"]),
}
