"""Ranges, pages, retries and what is not retried."""

import os
import uuid

import pytest

from pulsegrid.sources import pull

SCHEMA = "id long, v string"
QUICK = pull.Policy(page=7, wait=0.01)


def fetch_of(folder, fails=None, expires=()):
    """Rows 0..99, with the calls noted as files; ``fails`` pages fail that often, ``expires`` always."""
    fails = fails or {}

    def fetch(start, stop, after, limit):
        low = start if after is None else after + 1
        tag = f"{low}"
        tries = len([n for n in os.listdir(folder) if n.startswith(f"{tag}-")])
        open(os.path.join(folder, f"{tag}-{uuid.uuid4().hex}"), "w").close()
        if low in expires:
            raise pull.Expired("statement time limit")
        if tries < fails.get(low, 0):
            raise OSError("connection lost")
        return [(i, f"v{i}") for i in range(low, min(stop, low + limit))]

    return fetch


def calls(folder, low):
    return len([n for n in os.listdir(folder) if n.startswith(f"{low}-")])


def test_every_row_once_over_ranges_and_pages(spark, tmp_path):
    for parts in (1, 3, 8, 200):
        got = pull.pulled(spark, "t_pull", fetch_of(str(tmp_path)), SCHEMA, 0, 100, parts=parts, policy=QUICK).collect()
        assert sorted(r["id"] for r in got) == list(range(100)) and all(r["v"] == f"v{r['id']}" for r in got)
    assert pull.pulled(spark, "t_pull", fetch_of(str(tmp_path)), SCHEMA, 5, 5).count() == 0


def test_a_failed_page_is_asked_for_again(spark, tmp_path):
    fetch = fetch_of(str(tmp_path), fails={0: 2, 57: 1})
    got = pull.pulled(spark, "t_retry", fetch, SCHEMA, 0, 100, parts=2, policy=QUICK)
    assert got.count() == 100
    assert calls(tmp_path, 0) == 3 and calls(tmp_path, 57) == 2 and calls(tmp_path, 7) == 1


def test_tries_end_and_the_range_is_named(spark, tmp_path):
    with pytest.raises(pull.PullFailed, match=r"\[50, 100\): OSError: connection lost"):
        pull.pulled(spark, "t_gone", fetch_of(str(tmp_path), fails={57: 99}), SCHEMA, 0, 100, parts=2, policy=QUICK)
    assert calls(tmp_path, 57) == pull.ATTEMPTS


def test_a_time_out_is_not_retried(spark, tmp_path):
    """Neither by the policy nor by Spark: one call, and the other range is read."""
    with pytest.raises(pull.PullFailed, match=r"\[0, 50\): Expired"):
        pull.pulled(spark, "t_slow", fetch_of(str(tmp_path), expires={14}), SCHEMA, 0, 100, parts=2, policy=QUICK)
    assert calls(tmp_path, 14) == 1 and calls(tmp_path, 92) == 1


def test_waits_double():
    waited = []
    policy = pull.Policy(page=5, attempts=4)

    def broken(*_):
        raise OSError("down")

    original, pull.time.sleep = pull.time.sleep, waited.append
    try:
        with pytest.raises(OSError):
            policy.asked(broken, 0, 1, None)
    finally:
        pull.time.sleep = original
    assert waited == [2.0, 4.0, 8.0]
