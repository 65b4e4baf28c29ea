"""Rolling mart vs a plain-Python evaluation of the trailing-rows window."""

import datetime as dt
import random

import pytest

from attrix.operators.rolling import rolling_turnover

SCHEMA = ("month_start date, month_end date, location_state string, eom_headcount long, "
          "total_terminations long, voluntary_terminations long, involuntary_terminations long, "
          "regrettable_terminations long")


def expected(rows, months):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    for st, rs in by.items():
        rs.sort(key=lambda r: r[0])
        for i, r in enumerate(rs):
            win = rs[max(0, i - months + 1): i + 1]
            avg = sum(x[3] for x in win) / len(win)
            tot = sum(x[4] for x in win)
            rate = None if avg == 0 else round(tot / avg * 100, 2)
            out[(r[0], st)] = (len(win), tot, avg, rate, len(win) < months)
    return out


@pytest.mark.parametrize("seed,months", [(1, 12), (2, 3)])
def test_rolling_matches_python(spark, seed, months):
    rng = random.Random(seed)
    rows = []
    for st in ["A", "B", None]:
        m = dt.date(2020, 1, 1)
        for _ in range(30):
            if rng.random() < 0.15:          # a missing month: ROWS frames count rows, not months
                m = dt.date(m.year + (m.month // 12), m.month % 12 + 1, 1)
            vol, inv = rng.randint(0, 3), rng.randint(0, 2)
            rows.append((m, m, st, rng.choice([0, rng.randint(1, 40)]), vol + inv, vol, inv,
                         rng.randint(0, vol)))
            m = dt.date(m.year + (m.month // 12), m.month % 12 + 1, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.month_start, r.location_state):
           (r.months_in_window, r.rolling_12m_terminations, r.rolling_12m_avg_headcount,
            r.rolling_12m_turnover_rate, r.is_partial_window)
           for r in rolling_turnover(df, months=months).collect()}
    exp = expected(rows, months)
    assert got.keys() == exp.keys()
    for k, (n, tot, avg, rate, partial) in exp.items():
        g = got[k]
        assert (g[0], g[1], g[4]) == (n, tot, partial)
        assert g[2] == pytest.approx(avg)
        assert (g[3] is None and rate is None) or g[3] == pytest.approx(rate, abs=0.011)
