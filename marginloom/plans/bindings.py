"""The source tables of the plans, derived from the star-schema test tables.

Every source is a projection, filter or join of the given tables and grows with them. Blank
and missing values are derived too, because the test tables hold none.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from marginloom.functions.calendar import week_key
from marginloom.functions.channels import OrderRules
from marginloom.sources.rules import dated_rules_from_rows, rules_from_rows
from marginloom.types import money, quantity, text

AS_OF = "1998-06-15"
FY_START = "1997-11-01"
PLAN_MONTHS = ("1997-11-01", "1998-10-01")
MIN_YEAR = 1997
FX = "1.35"
CALLS_YEAR = 2024

# Labels of the test data's own brands; the prefixes are those the order numbers below carry.
ORDER_RULES = OrderRules(
    plain=(("0089400", "Costco"),),
    dashed=(("SO-EB-", "Brand#11"), ("SO-VM-", "Brand#12"), ("SO-MB-", "Brand#13"), ("SO-", "Brand#14")),
)
CHANNELS = ORDER_RULES.channels()

_PAYROLL_SHARES = [("B2B", "0.306944"), ("Retail", "0.365278"), ("Costco", "0.077778"), ("Unallocated", "0.25")]
RULE_ROWS: list[tuple] = [
    *[("salesperson", k, c, None) for k, c in (("2", "B2B"), ("3", "B2B"), ("4", "Costco"), ("5", "Costco"))],
    *[("vendor", k, "Retail", None) for k in ("1", "2", "3", "4")],
    *[("costco_account", k, "Costco", None) for k in ("STANDARD Brand#1", "LARGE Brand#2", "SMALL Brand#3")],
    ("so_prefix", "0089400", "Costco", "7"),
    ("so_prefix", "SO-EB-", "Retail", "6"),
    ("so_prefix", "SO-MB-", "Retail", "6"),
    ("default_channel", "blank_sp_invoice", "B2B", None),
    ("default_channel", "blank_sp_creditnote", "Retail", None),
    ("default_channel", "other_sp", "Retail", None),
    *[("payroll_pct", f"PROMO Brand#{n}", c, v) for n in (1, 2, 3) for c, v in _PAYROLL_SHARES],
    *[("ad_pct", f"PROMO Brand#{n}", c, v) for n in (4, 5) for c, v in (("B2B", "0.1"), ("Retail", "0.9"))],
    *[("payment_account", f"ECONOMY Brand#{n}", "Retail", "1") for n in (1, 2)],
    *[("commission_fee", f"ECONOMY Brand#{n}", c, None) for n in (3, 4) for c in ("B2B", "Retail")],
    ("unalloc_opex", "ECONOMY Brand#6", "Unallocated", None),
    *[("unalloc_other_exp", f"MEDIUM Brand#{n}", "Unallocated", None) for n in (1, 2, 3, 4)],
    *[("cogs_unalloc", k, "Unallocated", None) for k in ("LARGE Brand#4", "inventory_adjustment_by_quantity")],
]


#: From this day on some rules differ.
CHANGED = "1997-07-01"
_NEW_PAYROLL = [("B2B", "0.2"), ("Retail", "0.45"), ("Costco", "0.1"), ("Unallocated", "0.25")]
_ENDING = [
    ("salesperson", "3"), ("vendor", "4"), ("payroll_pct", "PROMO Brand#1"), ("payroll_pct", "PROMO Brand#2"), ("ad_pct", "PROMO Brand#5")
]
#: (type, key, channel, value, valid_from, valid_to): versions that end, versions that begin, a gap of four months.
DATED_RULE_ROWS: list[tuple] = [
    *[(*row, None, ("1997-03-01" if row[0] == "ad_pct" else CHANGED) if row[:2] in _ENDING else None) for row in RULE_ROWS],
    ("salesperson", "3", "Retail", None, CHANGED, None),
    ("vendor", "4", "Costco", None, CHANGED, "1998-01-01"),
    *[("payroll_pct", "PROMO Brand#1", c, v, CHANGED, None) for c, v in _NEW_PAYROLL],
    *[("payroll_pct", "PROMO Brand#2", c, v, CHANGED, None) for c, v in _NEW_PAYROLL],
    *[("ad_pct", "PROMO Brand#5", c, v, CHANGED, None) for c, v in (("B2B", "0.3"), ("Retail", "0.7"))],
    ("unalloc_opex", "ECONOMY Brand#5", "Unallocated", None, CHANGED, None),
]


# Schemas of the test tables.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _digits(name: str) -> str:
    return f"CAST({name} AS STRING)"


def _by_priority(*labels: str) -> str:
    """One label per order priority, 1 to 5; an empty label is NULL."""
    branches = " ".join(f"WHEN '{n}' THEN {text(label or None)}" for n, label in enumerate(labels, start=1))
    return f"CASE substring(o_orderpriority, 1, 1) {branches} END"


BRAND_OF_PRIORITY = _by_priority("Brand#11", "Brand#12", "Brand#13", "Brand#14", "Costco")
KIND_OF_PRIORITY = _by_priority("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")
SKU = "concat(p_brand, '-', p_type)"


class Sources:
    """Lazy source tables over one folder of test data."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One reader per table; the declared schema spares a job that reads file footers."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def rules(self) -> DataFrame:
        return rules_from_rows(self.spark, RULE_ROWS)

    @cached_property
    def dated_rules(self) -> DataFrame:
        return dated_rules_from_rows(self.spark, DATED_RULE_ROWS)

    # --- sales ---

    @cached_property
    def _documents(self) -> DataFrame:
        seller = "pmod(o_custkey, 25)"
        prefix = _by_priority("0089400", "SO-EB-", "SO-MB-", "SO-", "")
        total = money("o_totalprice")
        balance = f"CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN {total} ELSE {total} - 100 END"
        return self.table("orders").selectExpr(
            f"{_digits('o_orderkey')} AS invoice_id",
            f"{_digits('o_custkey')} AS customer_id",
            f"CASE {seller} WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {_digits(seller)} END AS sales_person_id",
            "concat('INV-', o_orderkey) AS invoice_number",
            "CAST(o_orderdate AS DATE) AS invoice_date",
            f"{total} AS total",
            f"{money(balance)} AS balance",
            "if(o_orderstatus = 'F', 'Closed', 'Open') AS status",
            "o_orderpriority AS source",
            "lower(substring(o_orderpriority, 3)) AS source_new",
            "o_orderstatus AS shipping_status",
            f"concat({prefix}, o_orderkey) AS so_number",
        )

    @cached_property
    def invoices(self) -> DataFrame:
        return self._documents.where("shipping_status <> 'P'")

    @cached_property
    def credit_notes(self) -> DataFrame:
        return self._documents.where("shipping_status = 'P'").selectExpr("invoice_id AS creditnote_id", "sales_person_id")

    @cached_property
    def invoice_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS item_id",
            f"{_digits('l_orderkey')} AS invoice_id",
            f"{_digits('l_partkey')} AS product_id",
            "concat('Item ', l_partkey) AS item_name",
            f"{quantity('l_quantity')} AS quantity",
            f"{money('l_extendedprice')} AS total",
            f"{_digits('l_suppkey')} AS warehouse_id",
        )

    @cached_property
    def _order_parts(self) -> DataFrame:
        """Sales orders behind an invoice: two, one or none by priority, a many-to-many link."""
        parts = """CASE o_orderpriority WHEN '1-URGENT' THEN array('0089400', 'SO-EB-') WHEN '2-HIGH' THEN array('SO-VM-', 'SO-MB-')
            WHEN '3-MEDIUM' THEN array('SO-') WHEN '4-NOT SPECIFIED' THEN array('PO-') END"""
        return self.table("orders").selectExpr("o_orderkey", "o_orderstatus", f"explode({parts}) AS prefix")

    @cached_property
    def sales_order_invoice(self) -> DataFrame:
        return self._order_parts.selectExpr(
            "concat('S', prefix, o_orderkey) AS sales_order_id", f"{_digits('o_orderkey')} AS invoice_id"
        )

    @cached_property
    def linked_sales_orders(self) -> DataFrame:
        return self._order_parts.selectExpr(
            "concat('S', prefix, o_orderkey) AS sales_order_id",
            "concat(prefix, o_orderkey) AS sales_order_no",
            "lower(o_orderstatus) AS type",
        )

    @cached_property
    def sales_orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"{_digits('o_orderkey')} AS sales_order_id",
            "concat('SO-', o_orderkey) AS sales_order_no",
            "'retail' AS type",
            "CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'confirmed' ELSE 'draft' END AS status",
            "CAST(o_orderdate AS DATE) AS order_date",
        )

    @cached_property
    def sales_order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{_digits('l_orderkey')} AS sales_order_id",
            "concat('Item ', l_partkey) AS item_name",
            f"{quantity('l_quantity')} AS quantity",
        )

    @cached_property
    def invoice_payments(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{_digits('l_orderkey')} AS invoice_id", "l_shipdate AS created_time", f"{money('l_extendedprice')} AS amount"
        )

    @cached_property
    def customers(self) -> DataFrame:
        kind = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'Dealer - Gold' WHEN 'HOUSEHOLD' THEN NULL ELSE lower(c_mktsegment) END"
        return self.table("customer").selectExpr(
            f"{_digits('c_custkey')} AS customer_id",
            f"{kind} AS account_type",
            "if(c_acctbal < 1000, 'person', 'business') AS contact_type",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"{_digits('p_partkey')} AS item_id",
            "concat('Item ', p_partkey) AS item_name",
            f"{SKU} AS sku",
            "p_type AS category_id",
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("part").selectExpr("p_type AS category_id", "p_type AS category_name").distinct()

    @cached_property
    def sales_persons(self) -> DataFrame:
        return self.table("nation").selectExpr(f"{_digits('n_nationkey')} AS sales_person_id", "n_name AS name")

    # --- advertising and deals ---

    def _ad_names(self, ad: str, name: str) -> DataFrame:
        return self.table("part").selectExpr(
            f"{_digits('p_partkey')} AS {ad}", f"concat_ws(' - ', p_brand, p_type, p_name) AS {name}"
        )

    @cached_property
    def fb_ad_sets(self) -> DataFrame:
        return self._ad_names("id", "name")

    @cached_property
    def g_campaigns(self) -> DataFrame:
        return self._ad_names("campaign_id", "campaign")

    def _ad_costs(self, flag: str, ad: str, day: str, cost: str) -> DataFrame:
        return (
            self.table("lineitem")
            .where(f"l_returnflag = '{flag}'")
            .selectExpr(
                f"{_digits('l_partkey')} AS {ad}",
                f"CAST(l_shipdate AS DATE) AS {day}",
                f"{money('l_extendedprice')} AS {cost}",
            )
        )

    @cached_property
    def fb_insights(self) -> DataFrame:
        return self._ad_costs("A", "adset_id", "reporting_starts", "amount_spent")

    @cached_property
    def g_performance(self) -> DataFrame:
        return self._ad_costs("R", "campaign_id", "day", "costs")

    @cached_property
    def other_spend(self) -> DataFrame:
        return (
            self.table("orders")
            .where("o_orderstatus = 'O'")
            .selectExpr(
                f"{week_key('o_orderdate')} AS year_week",
                f"{BRAND_OF_PRIORITY} AS channel",
                f"{KIND_OF_PRIORITY} AS product_category",
                f"{money('o_totalprice')} AS spending_cad",
            )
        )

    @cached_property
    def deals_weekly(self) -> DataFrame:
        deals = self.table("orders").selectExpr(
            f"{week_key('o_orderdate')} AS year_week",
            f"{BRAND_OF_PRIORITY} AS channel",
            "o_orderstatus",
            f"{money('o_totalprice')} AS value",
        )
        columns = {
            "pipeline": "sum(value) FILTER (WHERE o_orderstatus = 'O')",
            "weighted_pipeline": f"sum({money('value * 0.5')}) FILTER (WHERE o_orderstatus = 'O')",
            "deal_count": "count(*)",
            "qualification_cnt": "count_if(o_orderstatus = 'P')",
            "closed_won_cnt": "count_if(o_orderstatus = 'F')",
            "closed_lost_cnt": "count_if(o_orderstatus = 'O')",
        }
        return deals.groupBy("year_week", "channel").agg(*[F.expr(f"{e} AS {c}") for c, e in columns.items()])

    # --- stock and plan ---

    @cached_property
    def tracked_skus(self) -> DataFrame:
        """SKUs of the regular range; promotional articles are not tracked."""
        return self.items.where("category_id <> 'PROMO'").select("sku")

    @cached_property
    def stock_by_warehouse(self) -> DataFrame:
        parts = self.table("part").selectExpr("p_partkey AS l_partkey", f"{SKU} AS sku", "p_name AS item_name")
        signed = "if(l_linestatus = 'O', -l_quantity, l_quantity)"
        return (
            self.table("lineitem")
            .join(parts, "l_partkey", "inner")
            .selectExpr(
                "sku",
                "item_name",
                f"{quantity(signed)} AS quantity_available",
                f"{quantity('l_discount')} AS external_inv",
                f"{quantity('l_linenumber')} AS transit_inv",
            )
        )

    @cached_property
    def plan_monthly(self) -> DataFrame:
        first, last = (f"DATE'{month}'" for month in PLAN_MONTHS)
        sizes = self.table("part").where("p_type <> 'LARGE'").selectExpr(f"{SKU} AS sku", "p_size")
        return (
            sizes.groupBy("sku")
            .agg(F.expr("sum(p_size) AS size"))
            .selectExpr("sku", "size", f"explode(sequence({first}, {last}, INTERVAL 1 MONTH)) AS plan_month")
            .selectExpr("sku", "plan_month", f"{quantity('size + month(plan_month)')} AS planned_qty")
        )

    @cached_property
    def supply_lines(self) -> DataFrame:
        """Each line as a delivery, with the days until the next one: the time its stock must last."""
        parts = self.table("part").selectExpr("p_partkey AS l_partkey", f"{SKU} AS sku")
        return (
            self.table("lineitem")
            .join(parts, "l_partkey", "inner")
            .selectExpr(
                "l_orderkey AS order_key",
                "l_linenumber AS line_number",
                "sku",
                "CAST(l_shipdate AS DATE) AS first_day",
                "date_add(CAST(l_shipdate AS DATE), 7 * l_linenumber - 1) AS last_day",
            )
        )

    # --- calls ---

    @cached_property
    def call_logs(self) -> DataFrame:
        return (
            self.table("events")
            .where("event_type IN ('error', 'click', 'purchase')")
            .selectExpr(
                f"{_digits('event_id')} AS log_id",
                "CASE event_type WHEN 'error' THEN 'missed' WHEN 'click' THEN 'outgoing' ELSE 'incoming' END AS call_type",
                f"CASE user_id WHEN 7 THEN NULL WHEN 8 THEN '' ELSE {_digits('user_id')} END AS customer_number",
                "ts AS start_time",
                "if(value > 50, 'true', 'false') AS missed_call_returned",
            )
        )

    @cached_property
    def agent_metrics(self) -> DataFrame:
        """One leg per outgoing call, two per incoming one; recorded up to 14 seconds early."""
        agents = "if(event_type = 'click', array(event_id % 30), array(event_id % 30, event_id % 7))"
        return (
            self.table("events")
            .where("event_type IN ('click', 'purchase')")
            .selectExpr("*", f"explode({agents}) AS agent_key")
            .selectExpr(
                f"{_digits('event_id')} AS calllog_id",
                f"if(agent_key = 29, '', {_digits('agent_key')}) AS agent",
                "if(event_type = 'click', 'outgoing', 'incoming') AS call_type",
                "if(value < 10, 'no answer', 'answered') AS hangup_cause",
                "ts - make_dt_interval(0, 0, 0, event_id % 15) AS agent_called_time",
            )
        )

    @cached_property
    def agents(self) -> DataFrame:
        return self.table("nation").selectExpr(f"{_digits('n_nationkey')} AS agent_id", "n_name AS name")

    # --- ledger ---

    @cached_property
    def accounts(self) -> DataFrame:
        kind = """CASE p_type WHEN 'STANDARD' THEN 'Income' WHEN 'LARGE' THEN 'Cost Of Goods Sold'
            WHEN 'SMALL' THEN 'Other Income' WHEN 'MEDIUM' THEN 'Other Expense' ELSE 'Expense' END"""
        return self.table("part").selectExpr(
            f"{_digits('p_partkey')} AS account_id",
            "concat_ws(' ', p_type, p_brand) AS account_name",
            f"{kind} AS account_type",
        )

    @cached_property
    def ledger(self) -> DataFrame:
        entity_type = """CASE WHEN l_returnflag <> 'N' THEN 'invoice' WHEN l_linenumber <= 2 THEN 'bill'
            WHEN l_linenumber = 3 THEN 'inventory_adjustment_by_quantity' WHEN l_linenumber <> 4 THEN 'expense' END"""
        credit = f"{money('l_extendedprice')} + {money('l_quantity')}"
        return self.table("lineitem").selectExpr(
            f"{_digits('l_partkey')} AS account_id",
            f"if(l_returnflag <> 'N', {_digits('l_orderkey')}, NULL) AS entity_id",
            f"{entity_type} AS entity_type",
            f"{_digits('l_suppkey')} AS vendor_id",
            "CAST(l_shipdate AS DATE) AS transaction_date",
            f"{money('l_extendedprice')} AS debit_minus_credit",
            f"{money(credit)} AS credit_minus_debit",
        )

    @cached_property
    def po_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{_digits('l_partkey')} AS product_id",
            f"{money('l_extendedprice')} AS item_price",
            f"{quantity('l_quantity')} AS quantity",
        )

    # --- rule tables and lists as large as the data, for the checks ---

    @cached_property
    def article_rules(self) -> DataFrame:
        """Share of each article kind in its brand, rounded to two digits, so some brands miss 1."""
        kinds = self.table("part").groupBy("p_brand", "p_type").agg(F.expr("count(*) AS n"))
        brands = self.table("part").groupBy("p_brand").agg(F.expr("count(*) AS all_n"))
        return kinds.join(brands, "p_brand").selectExpr(
            "'payroll_pct' AS type",
            "p_brand AS key",
            "p_type AS channel",
            f"{quantity('round(CAST(n AS DOUBLE) / all_n, 2)')} AS value",
        )

    @cached_property
    def order_rules(self) -> DataFrame:
        """One rule per line and supplier, copies included; some keys look like spreadsheet numbers."""
        return self.table("lineitem").selectExpr(
            "if(l_linenumber = 2, 'so_prefix', 'vendor') AS type",
            f"if(l_linenumber = 1, concat(l_suppkey, '.97995E+18'), {_digits('l_suppkey')}) AS key",
            "l_returnflag AS channel",
            f"{quantity('if(l_linenumber = 2, 2, NULL)')} AS value",
        )

    @cached_property
    def vendor_rules(self) -> DataFrame:
        """One channel for most vendors, two for some; the first id of every fifth vendor is named by an intact rule."""
        channel = "if(l_suppkey % 7 = 0, l_returnflag, 'Retail')"
        number = "CAST(NULL AS DECIMAL(18,6)) AS value"
        damaged = self.table("lineitem").selectExpr("'vendor' AS type", "concat(l_suppkey, '.97995E+18') AS key", f"{channel} AS channel", number)
        intact = self.table("lineitem").where("l_suppkey % 5 = 0").selectExpr(
            "'vendor' AS type", "concat(l_suppkey, '97995', repeat('0', 13)) AS key", "'B2B' AS channel", number
        )
        return damaged.unionByName(intact)

    @cached_property
    def posting_ids(self) -> DataFrame:
        """Long ids of the ledger's vendors; one vendor has one to three, of which some round to the same six digits."""
        tail = "pmod(l_orderkey, l_suppkey % 3 + 1) * 3000000000000"
        return self.table("lineitem").selectExpr(f"concat(l_suppkey, '97995', lpad(CAST({tail} AS STRING), 13, '0')) AS id")

    @cached_property
    def customer_versions(self) -> DataFrame:
        """A rule per order: the customer's terms from its date for one to three months; some overlap, some leave gaps."""
        days = "30 + CAST(pmod(o_orderkey, 60) AS INT)"
        return self.table("orders").selectExpr(
            "'payroll_pct' AS type",
            f"{_digits('o_custkey')} AS key",
            "o_orderpriority AS channel",
            f"{quantity('if(o_orderstatus = \'F\', 1, 0.5)')} AS value",
            "CAST(o_orderdate AS DATE) AS valid_from",
            f"date_add(CAST(o_orderdate AS DATE), {days}) AS valid_to",
        )

    @cached_property
    def shipped_lines(self) -> DataFrame:
        """Lines with their customer and day."""
        buyers = self.table("orders").selectExpr("o_orderkey AS l_orderkey", f"{_digits('o_custkey')} AS key")
        return (
            self.table("lineitem")
            .join(buyers, "l_orderkey", "inner")
            .selectExpr("l_orderkey AS order_key", "l_linenumber AS line_number", "key", "CAST(l_shipdate AS DATE) AS day")
        )

    def customer_rules(self, status: str) -> DataFrame:
        """Customer to segment, as one version of the rules knows it: by the orders of one status."""
        buyers = self.table("orders").where(f"o_orderstatus = '{status}'").selectExpr("o_custkey AS c_custkey")
        people = self.table("customer").join(buyers, "c_custkey", "left_semi")
        return people.selectExpr(
            "'salesperson' AS type",
            f"{_digits('c_custkey')} AS key",
            "c_mktsegment AS channel",
            "CAST(NULL AS DECIMAL(18,6)) AS value",
        )

    @cached_property
    def portal_invoices(self) -> DataFrame:
        """Invoice numbers as a portal lists them: repeated, and some of them credit notes."""
        return self.table("lineitem").where("l_returnflag = 'A'").selectExpr("concat('INV-', l_orderkey) AS invoice_number")
