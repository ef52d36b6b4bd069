import datetime as dt

from marginloom.plans import inventory as inv


def test_order_lines_filter_and_fan_out(source, got):
    items = source("items", [{"item_name": "i", "sku": "A"}, {"item_name": "i", "sku": "B"}, {"item_name": "j", "sku": "C"}])
    orders = source(
        "sales_orders",
        [
            {"sales_order_id": "1", "sales_order_no": "n1", "status": "open", "order_date": "2025-01-01"},
            {"sales_order_id": "2", "sales_order_no": "n2", "status": "draft", "order_date": "2025-06-01"},
            {"sales_order_id": "3", "sales_order_no": "n3", "status": "open", "order_date": "2024-12-31"},
            {"sales_order_id": "4", "sales_order_no": "n4", "status": None, "order_date": "2025-06-01"},
        ],
    )
    lines = source("sales_order_items", [{"sales_order_id": str(n), "item_name": "i", "quantity": n} for n in (1, 2, 3, 4)])
    found = inv.sales_order_lines(lines, orders, items, ["A", "B"])
    assert got(found, "so_number", "sku", "quantity") == [("n1", "A", 1.0), ("n1", "B", 1.0)]
    tracked = items.where("sku = 'B'").select("sku")
    assert got(inv.sales_order_lines(lines, orders, items, tracked), "so_number", "sku") == [("n1", "B")]


def test_stock_may_be_negative(source, got):
    rows = [
        {"sku": "A", "item_name": "a", "quantity_available": -5, "external_inv": 1, "transit_inv": 0},
        {"sku": "A", "item_name": "a", "quantity_available": 2, "external_inv": 0, "transit_inv": 4},
        {"sku": "Z", "item_name": "z", "quantity_available": 9, "external_inv": 0, "transit_inv": 0},
    ]
    stock = inv.stock_on_hand(source("stock_by_warehouse", rows), ["A"])
    assert got(stock, "sku", "on_hand", "external_inv", "in_transit") == [("A", -3.0, 1.0, 4.0)]


def test_sales_vs_plan_shows_zero_months_and_repeated_plan_rows(source, make, got):
    plan = source(
        "plan_monthly",
        [
            {"sku": "A", "plan_month": "2025-11-01", "planned_qty": "6.1"},
            {"sku": "A", "plan_month": "2025-12-01", "planned_qty": "1"},
            {"sku": "B", "plan_month": "2025-11-01", "planned_qty": "2"},
            {"sku": "B", "plan_month": "2025-11-01", "planned_qty": "2"},
        ],
    )
    lines = make(
        "sku STRING, order_date DATE, quantity DECIMAL(18,6)",
        [("A", "2025-11-05", 2), ("A", "2025-11-30", 1), ("A", "2026-11-05", 7), ("B", "2025-11-01", 3)],
    )
    found = inv.sales_vs_plan(plan, lines)
    assert got(found, "sku", "plan_qty", "actual_qty") == [("A", 1.0, 0.0), ("A", 6.1, 3.0), ("B", 2.0, 6.0)]


def test_year_to_date_bounds_are_closed(make, got):
    lines = make("sku STRING, order_date DATE, quantity DECIMAL(18,6)", [("A", d, 1) for d in ("2025-10-31", "2025-11-01", "2026-01-10", "2026-01-11")])
    assert got(inv.ytd_actuals(lines, "2025-11-01", "2026-01-10")) == [("A", 2.0)]
    daily = make("sku STRING, plan_date DATE, daily_plan_qty DECIMAL(18,6)", [("A", d, "0.5") for d in ("2025-11-01", "2026-01-10", "2026-01-11")])
    assert got(inv.ytd_plan(daily, dt.date(2025, 11, 1), dt.date(2026, 1, 10))) == [("A", 1.0)]


def test_next_months_clamp_at_month_end(source, got):
    plan = source("plan_monthly", [{"sku": "A", "plan_month": f"2026-0{m}-01", "planned_qty": 10**m} for m in range(1, 6)])
    assert got(inv.next_months_plan(plan, "2026-01-31")) == [("A", 1100.0)]
    assert got(inv.next_months_plan(plan, "2026-01-31", (1,))) == [("A", 100.0)]


def test_daily_plan_covers_the_month(source):
    daily = inv.daily_plan(source("plan_monthly", [{"sku": "A", "plan_month": "2026-02-01", "planned_qty": "6.1"}]))
    rows = daily.collect()
    assert len(rows) == 28
    assert abs(float(sum(r["daily_plan_qty"] for r in rows)) - 6.1) < 1e-4


def test_coverage_windows_edges(make, got):
    start = dt.date(2026, 3, 1)
    days = [(0, 1), (27, 2), (28, 4), (41, 8), (42, 16), (55, 32), (56, 64), (-1, 128)]
    daily = make("sku STRING, plan_date DATE, daily_plan_qty DECIMAL(18,6)", [("A", start + dt.timedelta(d), q) for d, q in days])
    stock = make("sku STRING, item_name STRING, on_hand INT, in_transit INT, external_inv INT", [("A", "a", 1, 2, 3), ("A", "b", 1, 2, 3), ("Z", "z", 0, 0, 0)])
    found = inv.coverage_windows(stock, daily, start)
    assert got(found, "item_name", "plan_28d", "plan_42d", "plan_56d") == [("a", 3.0, 15.0, 63.0), ("b", 3.0, 15.0, 63.0)]


def test_coverage_status_and_performance(make, got):
    stock = make(
        "sku STRING, item_name STRING, on_hand DECIMAL(18,6), in_transit DECIMAL(18,6), external_inv DECIMAL(18,6)",
        [("A", "a", 5, 5, 0), ("B", "b", 5, 4, 9), ("C", "c", 1, 1, 1)],
    )
    plan = make("sku STRING, next_plan_qty DECIMAL(18,6)", [("A", 10), ("B", 10)])
    coverage = inv.inventory_coverage(stock, plan)
    status = inv.with_coverage_status(coverage)
    assert got(status, "sku", "total_available", "coverage_status") == [
        ("A", 10.0, "Sufficient"),
        ("B", 9.0, "Shortfall"),
        ("C", 2.0, "Shortfall"),
    ]
    ytd = make("sku STRING, ytd_actual_qty DECIMAL(18,6)", [("A", 3)])
    planned = make("sku STRING, ytd_plan_qty DECIMAL(18,6)", [("B", 4)])
    perf = inv.sku_performance(coverage, ytd, planned)
    assert got(perf, "sku", "ytd_actual_qty", "ytd_plan_qty") == [("A", 3.0, 0.0), ("B", 0.0, 4.0), ("C", 0.0, 0.0)]
    by_day = inv.coverage_by_day(stock, make("sku STRING, plan_date DATE, daily_plan_qty DECIMAL(18,6)", [("A", "2026-01-01", 1), ("A", "2026-01-02", 1)]))
    assert got(inv.coverage_by_day_ytd(by_day, ytd, planned), "sku", "ytd_actual_qty", "ytd_plan_qty") == [("A", 3.0, None)] * 2
