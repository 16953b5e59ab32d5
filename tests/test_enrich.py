import random

from helpers import final_plan, quotes, trades, utc

from pyspark.sql import functions as F
from tapeworks.operators.enrich import to_payload, with_quotes


def stamp(ms):
    return f"2024-05-01 {ms // 3600000:02}:{ms // 60000 % 60:02}:{ms // 1000 % 60:02}.{ms % 1000:03}"


def brute_force(trade_rows, quote_rows, within=None):
    result = {}
    for trade_id, symbol, _, _, at in trade_rows:
        seen = [(q_at, ask, bid) for s, bid, ask, q_at in quote_rows
                if s == symbol and at is not None and q_at is not None and q_at <= at
                and (within is None or (utc(at) - utc(q_at)).total_seconds() <= within)]
        result[trade_id] = (max(seen)[2], max(seen)[1]) if seen else (None, None)
    return result


def random_market(seed, n_trades, n_quotes, span):
    """A third of all rows of one symbol, many at the same times."""
    rng = random.Random(seed)
    pick = lambda: "HOT" if rng.random() < 0.4 else rng.choice(["A", "B", "C"])
    time = lambda: stamp(rng.randrange(span) // rng.choice([1, 500]) * rng.choice([1, 500]) % span)
    t = [(f"t{i}", pick(), 10.0, 1.0, time()) for i in range(n_trades)]
    q = []
    for _ in range(n_quotes):
        bid = round(rng.uniform(9, 11), 2)
        q.append((pick(), bid, bid + 0.25, time()))
    return t, q


def found(df):
    return {r.trade_id: (r.bid, r.ask) for r in df.collect()}


def test_against_brute_force(spark):
    for seed, span in ((1, 20_000), (2, 4_000_000), (3, 60_000_000)):
        t, q = random_market(seed, 200, 150, span)
        wanted = brute_force(t, q)
        assert found(with_quotes(trades(spark, *t), quotes(spark, *q))) == wanted
        # Small cells, cut into slices of a few trades.
        assert found(with_quotes(trades(spark, *t), quotes(spark, *q), cell_seconds=10, slice_rows=3)) == wanted


def test_age_limit_against_brute_force(spark):
    t, q = random_market(4, 200, 100, 4_000_000)
    assert found(with_quotes(trades(spark, *t), quotes(spark, *q), "2 minutes")) == brute_force(t, q, 120)


def test_trades_without_quote_or_time_stay(spark):
    at = "2024-05-01 10:00:00"
    t = [("a", "S", 10.0, 1.0, at), ("b", "S", 10.0, 1.0, None), ("c", None, 1.0, 1.0, at)]
    q = [("S", 9.0, 11.0, "2024-05-01 10:00:00.001"), ("S", 9.0, 11.0, None)]
    assert found(with_quotes(trades(spark, *t), quotes(spark, *q))) == {k: (None, None) for k in "abc"}


def test_repeated_trades_are_all_kept(spark):
    t = [(f"t{i}", "HOT", 10.0, 1.0, "2024-05-01 10:00:00") for i in range(500)]
    q = [("HOT", 9.0, 11.0, "2024-05-01 09:00:00")] * 3
    df = with_quotes(trades(spark, *t), quotes(spark, *q), slice_rows=20)
    assert df.count() == 500 and df.filter("bid = 9").count() == 500


def test_derived_columns(spark):
    t = trades(spark, ("a", "S", 10.5, 1.0, "2024-05-01 10:00:00"))
    q = quotes(spark, ("S", 9.0, 11.0, "2024-05-01 10:00:00"))
    row = with_quotes(t, q).first()
    assert (row["mid"], row.spread, row.slippage) == (10.0, 2.0, 0.5)
    assert with_quotes(t.withColumn("side", F.lit(" Sell ")), q).first().slippage == -0.5
    assert with_quotes(t.withColumn("side", F.lit("HOLD")), q).first().slippage is None


def test_payload_keeps_nulls_and_key(spark):
    t = trades(spark, ("a", "S", 10.5, 1.0, "2024-05-01 10:00:00"))
    sent = to_payload(with_quotes(t, quotes(spark))).first()
    assert sent.key == "S" and '"bid":null' in sent.value


def test_a_hot_cell_is_cut_into_slices(spark):
    from tapeworks.operators.enrich import prevailing_quotes

    t = trades(spark, *[("copy", "HOT", 10.0, 1.0, "2024-05-01 10:00:00")] * 400).repartition(8)
    t = t.unionByName(trades(spark, ("n", None, 1.0, 1.0, "2024-05-01 10:00:00")))
    q = quotes(spark, ("HOT", 9.0, 11.0, "2024-05-01 09:00:00"))
    tasks = prevailing_quotes(t, q, slice_rows=40).filter("symbol = 'HOT'").groupBy(F.spark_partition_id()).count()
    assert tasks.count() > 1 and tasks.agg(F.sum("count")).first()[0] == 400


def test_trades_are_shuffled_once_and_only_small_lists_broadcast(spark, sf_dir):
    from tapeworks.plans import fixtures as fx

    plan = final_plan(with_quotes(fx.event_trades(spark, sf_dir), fx.event_quotes(spark, sf_dir)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("Exchange hashpartitioning(symbol") >= 1
    assert all("slice" in line for line in plan.splitlines() if "Exchange" in line and "price" in line)
