import pytest

from lexweave.functions.register import register_all
from lexweave.plans.fixtures import READINGS
from lexweave.sources import ingest


def fetcher(*replies):
    """A fetcher with given replies, and what it waited for."""
    left, waits, now = list(replies), [], [0.0]

    def opener(url):
        r = left.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    def sleep(s):
        waits.append(s)
        now[0] += s

    return ingest.Fetcher(1.0, opener, sleep, lambda: now[0]), waits, left


def test_saved_once_with_a_record(tmp_path, spark):
    f, _, left = fetcher((200, {"A": "b"}, b"xyz"), (404, {}, b""), (200, {}, b"new"))
    dest = tmp_path / "a" / "x.bin"
    assert f.download("u", dest) == "downloaded" and dest.read_bytes() == b"xyz" and f.download("u", dest) == "skipped"
    assert f.download("v", tmp_path / "y") == "missing" and f.download("v", tmp_path / "y") == "missing"
    assert f.download("u", dest, force=True) == "downloaded" and dest.read_bytes() == b"new" and not left
    log = {r["url"]: (r["status"], r["bytes"]) for r in ingest.fetch_log(spark, f"{tmp_path}/*.json").unionByName(ingest.fetch_log(spark, f"{tmp_path}/a/*.json")).collect()}
    assert log == {"u": (200, 3), "v": (404, None)} and not list(tmp_path.rglob("*.part"))


def test_retries_and_waits(tmp_path):
    f, waits, _ = fetcher((503, {}, b""), OSError("down"), (429, {"Retry-After": "7"}, b""), (200, {}, b"k"))
    assert f.download("u", tmp_path / "x") == "downloaded" and waits == [2.0, 4.0, 7.0]
    f, waits, _ = fetcher(*[(500, {}, b"")] * 6)
    with pytest.raises(OSError, match="500"):
        f.download("u", tmp_path / "z")
    assert len(waits) == 5
    f, waits, _ = fetcher((200, {}, b"1"), (200, {}, b"2"))
    f.download("u", tmp_path / "p")
    f.download("u", tmp_path / "q")
    assert waits == [1.0]


def test_blocked(tmp_path):
    f, _, _ = fetcher((403, {}, b""))
    with pytest.raises(ingest.Blocked):
        f.download("u", tmp_path / "x")
    assert not list(tmp_path.iterdir())
    f, waits, _ = fetcher((403, {}, b""), (403, {}, b""), (200, {}, b"ok"))
    assert f.download_patiently("u", tmp_path / "x") == "downloaded" and waits.count(ingest.BLOCK_WAIT) == 2
    f, _, _ = fetcher((403, {}, b""))
    assert f.download("u", tmp_path / "y", missing=(403, 404)) == "missing"


def test_registered_functions(spark):
    assert register_all(spark, READINGS) == ["modern_variants", "reading_fits", "segment_reading", "transcriptions"]
    row = spark.sql("SELECT modern_variants('かう', true)[0] AS a, reading_fits('足場', 'あしば') AS b, transcriptions('せう', true, false)[0] AS c, segment_reading('足場', 'あしば')[1].kana AS d").first()
    assert tuple(row) == ("こう", True, "ショゥ", "ば")
