"""Reference tables against facts, links over validity intervals."""

import random

from blockwright.operators import crosschecks as C


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_spot_pairs(spark):
    f = spark.createDataFrame([("@1", "BUY", "A", True, "spot"), ("@1", "ASK", "B", True, "spot"), ("@2", "BUY", "X", True, "spot"), ("@2", "ASK", "B", True, "spot"), ("@3", "BUY", "A", True, "spot"), ("@4", "BUY", "A", True, "spot"), ("@4", "BUY", "Z", True, "spot"), ("@5", "BUY", "Q", False, "spot"), ("BTC", "BUY", "Q", True, "perp")],
                              "coin string, side string, fee_token string, crossed boolean, market_type string")
    p = spark.createDataFrame([("@1", "A", "B"), ("@2", "A", "B"), ("@4", "A", "B")], "coin string, base_symbol string, quote_symbol string")
    assert sorted(r["coin"] for r in C.spot_pair_differences(f, p).collect()) == ["@2", "@3"]


def test_tokens_and_dexes_and_settlements(spark):
    e = spark.createDataFrame([("send", "T", "0x2" + "0" * 37 + "1a", "d"), ("spot_transfer", "S", "u", "0x2" + "0" * 38 + "5"), ("send", "N", "u", "d"), ("deposit", "T", "0x2" + "0" * 38 + "1", None)], "ledger_type string, token string, user string, destination string")
    t = spark.createDataFrame([("T", 26), ("S", 6)], "name string, token_index long")
    assert rows(C.token_differences(e, t)) == [("S", 5)]
    r = spark.createDataFrame([(0, ""), (0, ""), (1, "x"), (2, "y"), (2, "z"), (3, "w")], "dex_index long, dex string")
    d = spark.createDataFrame([(0, ""), (1, "q"), (2, "y")], "dex_index long, name string")
    assert [x["dex_index"] for x in C.dex_differences(r, d).orderBy("dex_index").collect()] == [1, 2, 3]
    s = spark.createDataFrame([(1, 1.0), (2, 0.5), (3, None), (4, 1.0)], "outcome_id long, settle_fraction double")
    o = spark.createDataFrame([(1, 1.0), (2, 0.25), (3, None)], "outcome_id long, settle_fraction double")
    assert [x["outcome_id"] for x in C.settlement_differences(s, o).orderBy("outcome_id").collect()] == [2, 4]


def test_links_over_time_equal_brute_force(spark):
    r = random.Random(6)
    child = [(k, t, r.choice([None, *range(5)]), r.random() < 0.8) for k in range(12) for t in sorted(r.sample(range(60), 4))]
    parent = [(p, t, r.random() < 0.7) for p in range(4) for t in sorted(r.sample(range(60), 5))]
    want = []
    end = 10**6
    listed = {p: {s for (q, t, on), (_, u, _) in zip(own, [*own[1:], (0, end, 0)]) if on for s in range(t, min(u, 200))} for p in range(5) for own in [[x for x in parent if x[0] == p]]}
    for k in range(12):
        own = [x for x in child if x[0] == k]
        for (_, t, link, on), nxt in zip(own, [*own[1:], None]):
            to = nxt[1] if nxt else None
            if on and link is not None:
                stop = 200 if to is None else to
                forever = to is None and any(x[0] == link for x in parent) and [x for x in parent if x[0] == link][-1][2]
                covered = set(range(t, stop)) & listed.get(link, set())
                if len(covered) < stop - t or (to is None and not forever):
                    want.append((k, link, t, to))
    c = spark.createDataFrame(child, "entity long, observed_at long, link long, listed boolean")
    p = spark.createDataFrame(parent, "name long, observed_at long, listed boolean")
    assert rows(C.uncovered_links(c, p, ["entity"], "link", "name").drop("covered")) == sorted(want, key=str)
    assert {x["link"] for x in C.unknown_links(c, p, "link", "name").collect()} == {x[2] for x in child if x[2] is not None} - {0, 1, 2, 3}
