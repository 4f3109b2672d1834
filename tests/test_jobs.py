"""The jobs as a user runs them, on one small lake."""

from courierlake.__main__ import main
from courierlake.schemas import WIRE_ORDER_ITEMS, WIRE_ORDERS
from courierlake.sources import synth, wire
from courierlake.sources.lake import Lake

AS_OF = "2024-03-01 00:00:00"


def test_jobs(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    dated = ["--root", root, "--as-of", AS_OF]
    main(["synth", *dated, "--orders", "40", "--seed", "2"])
    main(["batch", *dated])
    made = synth.synth_orders(spark, 10, 8, AS_OF)
    for name, df, schema in (("orders", made.orders, WIRE_ORDERS), ("items", made.order_items, WIRE_ORDER_ITEMS)):
        wire.encode(df, schema).coalesce(1).write.text(str(tmp_path / name))
    main(["ingest", "--root", root, "--orders-from", str(tmp_path / "orders"), "--items-from",
          str(tmp_path / "items"), "--refresh", "--idle-seconds", "12", "--max-seconds", "60"])
    lake = Lake(spark, root)
    assert lake.safe_count("bronze", "bronze_orders") == 50
    assert lake.safe_count("silver", "silver_scored_orders") == 10
    capsys.readouterr()
    for job in ("verify", "report", "describe"):
        main([job, "--root", root])
    shown = capsys.readouterr().out
    assert "bronze_order_items" in shown and "total_revenue" in shown
    main(["stream", *dated, "--orders-from", str(tmp_path / "orders"), "--items-from", str(tmp_path / "items"),
          "--idle-seconds", "15", "--max-seconds", "90"])
    assert lake.safe_count("gold", "fact_orders_stream") == 10
    assert lake.safe_count("gold", "fact_order_items_stream") > 0
    progress = spark.read.parquet(f"{root}/stream_progress")
    assert {r[0] for r in progress.select("query").distinct().collect()} == {
        "bronze_orders", "bronze_order_items", "order_states", "order_lines"}
    capsys.readouterr()
    main(["health", "--root", root])
    assert "Critical" in capsys.readouterr().out
    main(["late", *dated])
    main(["confirm", *dated])
    assert "days rebuilt: []" in capsys.readouterr().out
