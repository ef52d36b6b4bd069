import pytest
from pyspark.sql import functions as F

from marginloom.plans import pnl, quality
from marginloom.sources import rules_from_rows

PAYROLL = [("B2B", "0.306944"), ("Retail", "0.365278"), ("Costco", "0.077778"), ("Unallocated", "0.25")]
RULES = [
    ("salesperson", "rep", "B2B", None),
    ("salesperson", "club rep", "Costco", None),
    ("vendor", "v1", "Retail", None),
    ("costco_account", "Club sales", "Costco", None),
    ("cogs_unalloc", "Subcontract", "Unallocated", None),
    ("cogs_unalloc", "inventory_adjustment_by_quantity", "Unallocated", None),
    *[("payroll_pct", "Wages", c, v) for c, v in PAYROLL],
    ("ad_pct", "Ads", "B2B", "0.1"),
    ("ad_pct", "Ads", "Retail", "0.9"),
    ("payment_account", "Card fees", "Retail", "1"),
    ("commission_fee", "Commission", "B2B", None),
    ("commission_fee", "Commission", "Retail", None),
    ("unalloc_opex", "Exchange", "Unallocated", None),
    ("unalloc_other_exp", "Grant", "Unallocated", None),
    ("so_prefix", "0089400", "Costco", "7"),
    ("so_prefix", "SO-EB-", "Retail", "6"),
    ("default_channel", "blank_sp_invoice", "B2B", None),
]
ACCOUNTS = [
    ("1", "Sales", "Income"), ("2", "Club sales", "Income"), ("3", "Freight", "Cost Of Goods Sold"),
    ("4", "Subcontract", "Cost Of Goods Sold"), ("5", "Interest", "Other Income"), ("10", "Wages", "Expense"),
    ("11", "Ads", "Expense"), ("12", "Card fees", "Expense"), ("13", "Commission", "Expense"),
    ("14", "Exchange", "Expense"), ("15", "Rent", "Expense"), ("20", "Grant", "Other Expense"), ("21", "Fines", "Other Expense"),
]
DOCUMENTS = [
    ("rep-doc", "rep", "SO-1"), ("club-doc", "club rep", "SO-1"), ("other-doc", "someone", "SO-1"),
    ("pre-club", None, "0089400-7"), ("pre-retail", "", "SO-MB-7"), ("pre-none", "", "SO-9"), ("no-number", None, None),
]


@pytest.fixture(scope="module")
def books(spark, source):
    def entry(account, amount, entity=None, entity_type="bill", vendor=None, day="2025-03-01"):
        return {
            "account_id": account, "entity_id": entity, "entity_type": entity_type, "vendor_id": vendor,
            "transaction_date": day, "debit_minus_credit": amount, "credit_minus_debit": amount,
        }

    ledger = source(
        "ledger",
        [
            entry("2", 1),  # account rule
            entry("3", 2, vendor="v1"),  # vendor rule
            entry("3", 100),  # shared cost
            entry("3", 4, entity_type="inventory_adjustment_by_quantity"),
            entry("3", 5, entity_type=None),
            entry("4", 6),  # kept account
            entry("1", 7, entity="unknown"),
            entry("1", 60, entity="rep-doc"),
            entry("1", 9, entity="club-doc"),
            entry("2", 10, entity="other-doc"),  # a known document outranks the account rule
            entry("1", 11, entity="credit"),
            entry("1", 12, entity="pre-club"),
            entry("1", 13, entity="pre-retail"),
            entry("1", 14, entity="pre-none"),
            entry("1", 15, entity="no-number"),
            entry("5", 16, entity="rep-doc"),
            entry("10", 100), entry("11", 100), entry("12", 100), entry("13", 100), entry("14", 100), entry("15", 100),
            entry("20", 100), entry("21", 100, day="2025-03-02"),
        ],
    )
    accounts = source("accounts", [dict(zip(("account_id", "account_name", "account_type"), a)) for a in ACCOUNTS])
    invoices = source(
        "invoices", [dict(zip(("invoice_id", "sales_person_id", "so_number"), d)) for d in DOCUMENTS]
    )
    bridge = pnl.entity_bridge(
        pnl.invoice_bridge(invoices), source("credit_notes", [{"creditnote_id": "credit", "sales_person_id": ""}])
    )
    lines = source(
        "invoice_items",
        [
            {"invoice_id": "rep-doc", "product_id": "p", "quantity": 3},
            {"invoice_id": "club-doc", "product_id": "p", "quantity": 1},
            {"invoice_id": "pre-club", "product_id": "q", "quantity": 6},
            {"invoice_id": "gone", "product_id": "q", "quantity": 50},
        ],
    )
    orders = [("p", 10, 1), ("p", 20, 3), ("q", 5, 2), ("none", 5, 0)]
    po_items = source("po_items", [{"product_id": p, "item_price": c, "quantity": n} for p, c, n in orders])
    rules = rules_from_rows(spark, RULES)
    return dict(ledger=ledger, accounts=accounts, bridge=bridge, rules=rules, lines=lines, invoices=invoices, po_items=po_items)


@pytest.fixture(scope="module")
def revenue(books):
    return pnl.channel_revenue(books["ledger"], books["accounts"], books["bridge"], books["rules"])


def test_every_branch_of_the_channel_priority(revenue, got):
    found = {amount: (section, channel) for section, amount, channel in got(revenue, "pl_section", "amount", "channel")}
    income, cost = pnl.OPERATING_INCOME, pnl.COST_OF_GOODS
    assert found == {
        1.0: (income, "Costco"),
        2.0: (cost, "Retail"),
        100.0: (cost, "ProRataAlloc"),
        4.0: (cost, "Unallocated"),
        5.0: (cost, "Unallocated"),
        6.0: (cost, "Unallocated"),
        7.0: (income, "Unallocated"),
        60.0: (income, "B2B"),
        9.0: (income, "Costco"),
        10.0: (income, "Retail"),
        11.0: (income, "Retail"),
        12.0: (income, "Costco"),
        13.0: (income, "Retail"),
        14.0: (income, "B2B"),
        15.0: (income, "B2B"),
        16.0: (pnl.OTHER_INCOME, "B2B"),
    }


def test_blank_seller_rules_can_be_read_from_the_rules_table(books):
    blank = pnl.BlankSellerRules.from_rules(books["rules"])
    one = blank.table.first()["blank"]
    assert [(p["key"], p["channel"]) for p in one["prefixes"]] == [("0089400", "Costco"), ("SO-EB-", "Retail")]
    assert (one["invoice"], one["credit_note"], one["other_seller"]) == ("B2B", "Retail", "Retail")
    table = pnl.channel_revenue(books["ledger"], books["accounts"], books["bridge"], books["rules"], blank)
    # without its prefix rule the order falls to the default
    assert {float(r["amount"]): r["channel"] for r in table.collect()}[13.0] == "B2B"


def test_po_cost(books, got):
    average = pnl.avg_po_cost(books["po_items"])
    assert got(average) == [("none", None), ("p", 17.5), ("q", 5.0)]
    cost = pnl.channel_po_cost(books["lines"], books["invoices"], average, books["rules"])
    assert got(cost) == [("B2B", 52.5), ("Costco", 17.5), ("Retail", 30.0)]


def test_shared_cost_follows_purchase_cost(books, revenue, got):
    cost = pnl.channel_po_cost(books["lines"], books["invoices"], pnl.avg_po_cost(books["po_items"]), books["rules"])
    split = pnl.allocate_cogs(revenue, pnl.po_cost_shares(cost))
    assert got(split, "channel", "amount") == [("B2B", 52.5), ("Costco", 17.5), ("Retail", 30.0)]


@pytest.fixture(scope="module")
def opex(books):
    return pnl.operating_expenses(books["ledger"], books["accounts"])


def test_static_split(books, opex, got):
    assert got(pnl.allocate_static(opex, books["rules"], "payroll_pct"), "channel", "amount") == [
        ("B2B", 30.6944), ("Costco", 7.7778), ("Retail", 36.5278), ("Unallocated", 25.0),
    ]
    assert got(pnl.allocate_static(opex, books["rules"], "ad_pct"), "channel", "amount") == [("B2B", 10.0), ("Retail", 90.0)]
    assert got(pnl.tag_unallocated(opex, books["rules"], "unalloc_opex"), "account_name", "channel", "amount") == [
        ("Exchange", "Unallocated", 100.0)
    ]


def test_share_split(books, opex, make, got):
    income = make(
        "pl_section STRING, channel STRING, amount DECIMAL(18,4)",
        [(pnl.OPERATING_INCOME, "B2B", 60), (pnl.OPERATING_INCOME, "Retail", 30), (pnl.OPERATING_INCOME, "Costco", 10), (pnl.OTHER_INCOME, "B2B", 999), (pnl.OPERATING_INCOME, "Unallocated", 999)],
    )
    shares = pnl.revenue_shares(income)
    assert got(pnl.allocate_other_opex(opex, books["rules"], shares), "account_name", "channel", "amount") == [
        ("Rent", "B2B", 60.0), ("Rent", "Costco", 10.0), ("Rent", "Retail", 30.0),
    ]
    two = pnl.revenue_shares(income, pnl.COMMISSION_CHANNELS)
    commission = got(pnl.allocate_commission(opex, books["rules"], two), "channel", "amount")
    assert [(c, round(a, 2)) for c, a in commission] == [("B2B", 66.67), ("Retail", 33.33)]


def test_no_share_base_gives_null_amounts(books, opex, revenue, got):
    none = pnl.revenue_shares(revenue.where("FALSE"))
    assert got(none) == [("B2B", None), ("Costco", None), ("Retail", None)]
    assert got(pnl.allocate_other_opex(opex, books["rules"], none), "channel", "amount") == [("B2B", None), ("Costco", None), ("Retail", None)]


def parts_of(books, revenue):
    rules = books["rules"]
    opex = pnl.operating_expenses(books["ledger"], books["accounts"])
    other = pnl.other_expenses(books["ledger"], books["accounts"])
    shares, two = pnl.revenue_shares(revenue), pnl.revenue_shares(revenue, pnl.COMMISSION_CHANNELS)
    cost = pnl.channel_po_cost(books["lines"], books["invoices"], pnl.avg_po_cost(books["po_items"]), rules)
    return [
        pnl.allocate_static(opex, rules, "payroll_pct"),
        pnl.opex_alloc(opex, rules, shares, two),
        pnl.tag_unallocated(opex, rules, "unalloc_opex"),
        pnl.allocate_other_expense(other, rules, shares),
        pnl.allocate_cogs(revenue, pnl.po_cost_shares(cost)),
    ]


def test_two_pass_statement_equals_the_union_of_parts(books, revenue, got):
    parts = pnl.channel_pl(revenue, *parts_of(books, revenue))
    assert got(pnl.channel_statement(**books)) == got(parts)


def test_allocation_conserves_every_account(books):
    statement = pnl.channel_statement(**books)
    opex = pnl.operating_expenses(books["ledger"], books["accounts"])
    checked = quality.conservation(opex, statement.where("pl_section LIKE '3%'"), ["account_name"])
    assert checked.count() == 6
    assert all(abs(r["difference"]) < 1e-9 for r in checked.collect())


def test_net(make, got):
    rows = [(pnl.OPERATING_INCOME, 100), (pnl.COST_OF_GOODS, 40), (pnl.OPERATING_EXPENSE, 10), (pnl.OTHER_INCOME, 5), (pnl.OTHER_EXPENSE, 3)]
    pl = make(
        "pl_section STRING, account_name STRING, transaction_date DATE, amount DECIMAL(18,4), channel STRING",
        [(s, "x", "2025-01-01", a, "B2B") for s, a in rows] + [(pnl.OPERATING_INCOME, "x", "2025-01-02", 1, "Retail")],
    )
    assert got(pnl.net_profit(pl), "pl_section", "amount", "channel") == [
        (pnl.NET, 1.0, "Retail"),
        (pnl.NET, 52.0, "B2B"),
    ]
    assert pnl.with_net(pl).count() == 8


def test_pivot_with_dates(books, got):
    pivot = pnl.profitability_pivot(pnl.channel_statement(**books), "2025-03-01", "2025-03-01")
    assert pivot.columns == ["pl_section", "account_name", "B2B", "Retail", "Costco", "Unallocated"]
    assert got(pivot.where("account_name = 'Wages'"), "B2B", "Retail", "Costco", "Unallocated") == [(30.6944, 36.5278, 7.7778, 25.0)]
    assert pivot.where("account_name = 'Fines'").count() == 0


def test_pivot_holds_every_channel_that_occurs(spark, books):
    more = rules_from_rows(spark, [("vendor", "v9", "Wholesale", None), ("unalloc_opex", "Rent", "Head office", None)])
    wide = dict(books, rules=books["rules"].unionByName(more))
    statement = pnl.channel_statement(**wide)
    channels = pnl.report_channels(wide["rules"])
    assert channels == ["B2B", "Retail", "Costco", "Unallocated", "Head office", "Wholesale"]
    assert statement.where("channel = 'Head office'").count() > 0
    pivot = pnl.profitability_pivot(statement, channels=channels)
    total = sum(v or 0 for r in pivot.select(*channels).collect() for v in r)
    assert total == statement.agg(F.sum("amount")).first()[0]
    with pytest.raises(Exception, match="no pivot column"):
        pnl.profitability_pivot(statement).collect()


def test_net_statement_equals_net_of_the_statement(books, got):
    columns = ["pl_section", "account_name", "transaction_date", "amount", "channel"]
    assert got(pnl.net_statement(**books), *columns) == got(pnl.net_profit(pnl.channel_statement(**books)), *columns)


def test_entity_types_that_stay_unallocated_come_from_the_rules(books):
    shared = lambda rules: pnl.channel_revenue(
        books["ledger"], books["accounts"], books["bridge"], rules
    ).where("channel = 'ProRataAlloc'").count()
    all_rules = books["rules"]
    assert shared(all_rules.where("key <> 'inventory_adjustment_by_quantity'")) == shared(all_rules) + 1


def test_any_number_of_prefix_rules(spark, books):
    many = rules_from_rows(spark, [("so_prefix", f"X{i:05d}", "Retail", None) for i in range(3000)])
    blank = pnl.BlankSellerRules.from_rules(books["rules"].unionByName(many))
    assert len(blank.table.first()["blank"]["prefixes"]) == 3002


def test_older_rules(books, opex, got):
    split = pnl.fixed_split(opex, include=["Rent"])
    assert got(split, "channel", "amount") == [("B2B", 37.2511), ("Costco", 12.8029), ("Retail", 49.946)]
    rest = pnl.fixed_split(opex, {"Retail": "1"}, exclude=["Rent", "Exchange"], exclude_prefixes=("Wag", "Ad"))
    assert got(rest, "account_name", "amount") == [("Card fees", 100.0), ("Commission", 100.0)]
    basic = pnl.assign_channel_basic(books["ledger"], books["accounts"], books["invoices"], ["rep"], ["club rep"])
    found = {amount: channel for amount, channel in got(basic, "amount", "channel")}
    assert [found[a] for a in (1.0, 60.0, 9.0, 10.0, 11.0, 12.0, 13.0, 14.0)] == [
        "Unallocated", "B2B", "Costco", "Retail", "Unallocated", "Costco", "Retail", "B2B",
    ]
