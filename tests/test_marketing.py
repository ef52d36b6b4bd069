import pytest

from marginloom.functions import OrderRules
from marginloom.plans import marketing as mk

RULES = OrderRules(plain=(("0089400", "Club"),), dashed=(("SO-EB-", "East"), ("SO-", "House")))
WEEK1, WEEK2, WEEK3 = "2024-05", "2024-06", "2024-07"


@pytest.fixture(scope="module")
def spend(source):
    names = [{"id": "1", "name": "House - Bike - x"}, {"id": "2", "name": "House - Bike - x"}, {"id": "3", "name": "East - Kit - y"}]
    costs = [("1", "2024-01-29", "10"), ("2", "2024-02-04", "20.5"), ("1", "2024-02-05", "1"), ("3", "2024-01-30", "-4"), ("9", "2024-01-30", "5")]
    campaigns = [{"campaign_id": "7", "campaign": "House - Bike - z"}]
    return mk.ad_spend(
        source("fb_ad_sets", names),
        source("fb_insights", [{"adset_id": a, "reporting_starts": d, "amount_spent": v} for a, d, v in costs]),
        source("g_campaigns", campaigns),
        source("g_performance", [{"campaign_id": "7", "day": "2024-01-31", "costs": "51180.10"}]),
        source(
            "other_spend",
            [
                {"year_week": WEEK1, "channel": "House", "product_category": "Bike", "spending_cad": "7.005"},
                {"year_week": WEEK1, "channel": "House", "product_category": "Bike", "spending_cad": "1"},
                {"year_week": WEEK1, "channel": "House", "product_category": "Bike", "spending_cad": "0"},
            ],
        ),
    )


def test_ad_spend_groups_by_name_and_keeps_manual_rows(spend, got):
    found = got(spend, "year_week", "name", "channel", "product_category", "fb_usd", "fb_cad", "google_cad", "other_cad")
    assert found == [
        (WEEK1, "House", "House", "Bike", 0.0, 0.0, 0.0, 1.0),
        (WEEK1, "House", "House", "Bike", 0.0, 0.0, 0.0, 7.01),
        (WEEK1, "House - Bike - x", "House", "Bike", 30.5, 41.18, 0.0, 0.0),
        (WEEK1, "House - Bike - z", "House", "Bike", 0.0, 0.0, 69093.14, 0.0),
        (WEEK2, "House - Bike - x", "House", "Bike", 1.0, 1.35, 0.0, 0.0),
    ]


def test_category_total_leaves_manual_spend_out(spend, got):
    found = got(mk.spend_by_category(spend), "year_week", "item_category", "total_spend_cad", "fb_spend_usd")
    assert found == [(WEEK1, "Bike", 69134.32, 30.5), (WEEK2, "Bike", 1.35, 1.0)]
    assert got(mk.spend_by_channel(spend), "year_week", "other_cad") == [(WEEK1, 8.01), (WEEK2, 0.0)]


def test_scaffold(spark, got):
    weeks = mk.week_channel_scaffold(spark, "2024-02-01", "2024-02-12", ["House", "East"])
    assert got(weeks, "year_week", "channel") == [(w, c) for w in (WEEK1, WEEK2, WEEK3) for c in ("East", "House")]
    first = weeks.where("year_week = '2024-05'").selectExpr("CAST(week_start AS STRING)", "CAST(week_end AS STRING)").first()
    assert tuple(first) == ("2024-01-29", "2024-02-04")


@pytest.fixture(scope="module")
def tables(spark, source):
    def invoice(key, customer, day, status="Closed", total="100", balance="0"):
        return {
            "invoice_id": key, "customer_id": customer, "sales_person_id": "s1", "invoice_number": "INV-" + key,
            "invoice_date": day, "total": total, "balance": balance, "status": status,
        }

    invoices = source(
        "invoices",
        [
            invoice("i1", "c1", "2024-01-30"),
            invoice("i2", "c2", "2024-02-06"),
            invoice("i3", "c3", "2024-01-31", balance="100"),
            invoice("i4", "c1", "2024-01-31", status="Open"),
            invoice("i5", "c4", "2024-02-01", balance="3"),
        ],
    )
    junction = source(
        "sales_order_invoice",
        [{"sales_order_id": o, "invoice_id": i} for o, i in (("o1", "i1"), ("o2", "i1"), ("o3", "i2"), ("o4", "i3"))],
    )
    orders = source(
        "sales_orders",
        [{"sales_order_id": o, "sales_order_no": n, "type": "t"} for o, n in (("o1", "SO-1"), ("o2", "SO-2"), ("o3", "SO-3"), ("o4", "SO-EB-4"))],
    )
    customers = source(
        "customers",
        [
            {"customer_id": "c1", "account_type": None, "contact_type": "person"},
            {"customer_id": "c2", "account_type": "Dealer - Gold"},
            {"customer_id": "c3", "account_type": "Retail"},
        ],
    )
    lines = source(
        "invoice_items",
        [
            {"item_id": "l1", "invoice_id": "i1", "product_id": "p1", "quantity": 1, "total": 60},
            {"item_id": "l2", "invoice_id": "i1", "product_id": "p1", "quantity": 1, "total": 40},
            {"item_id": "l3", "invoice_id": "i3", "product_id": "p9", "quantity": 1, "total": 100},
            {"item_id": "l9", "invoice_id": "i2", "product_id": "p1", "quantity": 1, "total": 100},
        ],
    )
    closed = mk.closed_invoices(invoices, junction, orders, RULES)
    payments = source("invoice_payments", [{"invoice_id": i, "created_time": "2024-01-30 10:00:00", "amount": a} for i, a in (("i1", 30), ("i1", 20), ("i2", 7), ("i9", 5), ("i5", 2))])
    paid = mk.weekly_payments(payments, invoices, junction, orders, customers, RULES)
    deals = source("deals_weekly", [{"year_week": WEEK1, "channel": "House", "pipeline": 11, "deal_count": 2}])
    return dict(
        scaffold=mk.week_channel_scaffold(spark, "2024-01-29", "2024-02-25", RULES.channels()),
        closed=closed,
        customers=customers,
        lines=lines,
        items=source("items", [{"item_id": "p1", "sku": "A", "category_id": "k"}]),
        categories=source("categories", [{"category_id": "k", "category_name": "Bike"}]),
        sales_persons=source("sales_persons", [{"sales_person_id": "s1", "name": "Robin"}]),
        payments=paid,
        deals=deals,
        as_of="2024-02-14",
    )


def test_closed_invoices_repeat_per_order(tables, got):
    found = got(tables["closed"], "invoice_id", "sales_order_no", "channel", "so_channel_old", "invoice_week")
    assert found == [
        ("i1", "SO-1", "House", "House", WEEK1),
        ("i1", "SO-2", "House", "House", WEEK1),
        ("i2", "SO-3", "House", "House", WEEK2),
        ("i3", "SO-EB-4", "East", "East", WEEK1),
        ("i5", None, "No SO", "", WEEK1),
    ]


def test_payments_count_once_per_order_and_skip_dealers(tables, got):
    assert got(tables["payments"], "channel", "paid_total") == [("House", 100.0), ("No SO", 7.0)]


def test_by_category_has_38_columns_and_the_expected_rows(spend, tables, got):
    table = mk.sales_and_spend_by_category(spend, **tables)
    assert len(table.columns) == 38
    house = table.where("channel = 'House' AND invoice_id IS NOT NULL")
    found = got(house, "invoice_id", "sales_order_number", "item_total", "item_category", "fb_spend", "total_paid", "pipeline_amount", "invoice_paid_status", "is_first_row")
    # two lines x two orders; both orders of the smallest line carry the flag
    assert found == [
        ("i1", "SO-1", 40.0, "Bike", 41.18, 100.0, 11.0, "Paid", 0),
        ("i1", "SO-1", 60.0, "Bike", 41.18, 100.0, 11.0, "Paid", 1),
        ("i1", "SO-2", 40.0, "Bike", 41.18, 100.0, 11.0, "Paid", 0),
        ("i1", "SO-2", 60.0, "Bike", 41.18, 100.0, 11.0, "Paid", 1),
    ]
    other = table.where("invoice_id IN ('i3', 'i5')")
    assert got(other, "invoice_id", "channel", "item_category", "total_spend", "invoice_paid_status", "is_first_row") == [
        ("i3", "East", None, None, "Not Paid", 1),
        ("i5", "No SO", None, None, "Partial", 0),
    ]


def test_empty_weeks_stay_but_dealer_weeks_go(spend, tables, got):
    table = mk.sales_and_spend_by_category(spend, **tables).where("invoice_id IS NULL AND channel = 'House'")
    assert got(table, "year_week", "invoice_week", "invoice_date_start", "is_first_row") == [(WEEK3, None, "2024/02/12", 0)]
    kept = mk.sales_and_spend_by_category(spend, **tables, exclude_before_join=True)
    assert got(kept.where("invoice_id IS NULL AND channel = 'House'"), "year_week") == [(WEEK2,), (WEEK3,)]


def test_by_channel_spreads_channel_spend_over_empty_weeks(spend, tables, got):
    table = mk.sales_and_spend_by_channel(spend, **tables)
    house = table.where("channel = 'House'").select("year_week", "fb_spend", "other_spend", "total_spend").distinct()
    assert got(house) == [(WEEK1, 41.18, 8.01, 69142.33), (WEEK3, None, None, None)]


def test_a_week_key_of_two_weeks_repeats_rows_and_takes_payments_of_both(spark, spend, tables, source, got):
    """The Mondays 2024-01-01 and 2024-12-30 share the key 2024-01; a table up to the second has rows of both."""
    days = [("i1", "2024-01-02"), ("i2", "2024-12-31"), ("i3", "2024-06-04")]
    invoices = source("invoices", [{"invoice_id": i, "invoice_date": d, "status": "Closed"} for i, d in days])
    payments = source("invoice_payments", [{"invoice_id": i, "created_time": f"{d} 10:00:00", "amount": 1} for i, d in days])
    none = source("sales_order_invoice", []), source("sales_orders", [])
    customers, last = source("customers", []), "2024-12-31"
    given = tables | dict(
        scaffold=mk.week_channel_scaffold(spark, "2024-01-01", last, RULES.channels()),
        closed=mk.closed_invoices(invoices, *none, RULES),
        payments=mk.weekly_payments(payments, invoices, *none, customers, RULES, last=last),
        customers=customers,
        as_of=last,
    )
    table = mk.sales_and_spend_by_channel(spend, **given).where("invoice_id IS NOT NULL")
    # two lines and one, each in both weeks
    assert got(table, "invoice_id", "year_week", "total_paid") == [(i, "2024-01", 2.0) for i in ["i1"] * 4 + ["i2"] * 2]


def test_unique_flag_marks_one_row_per_group(spend, tables):
    table = mk.sales_and_spend_by_category(spend, **tables, unique_flag=True)
    flagged = table.where("is_first_row = 1 AND channel = 'House'").collect()
    assert [(r["sales_order_number"], float(r["item_total"])) for r in flagged] == [("SO-1", 60.0)]


def test_newest_weeks_first(spend):
    weeks = [r["year_week"] for r in mk.newest_weeks_first(spend).collect()]
    assert weeks == sorted(weeks, reverse=True)
