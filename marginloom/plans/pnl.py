"""Channel profit and loss: ledger rows to channels, shared costs to channels by rules and shares.

Rules may be dated (columns valid_from and valid_to, see ``operators.validity``): then a ledger row follows the
rules of its own date, and an invoice line those of the invoice date. Prefix rules and defaults are not dated.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marginloom.functions.channels import prefix_branches
from marginloom.operators.allocate import allocate_by_share, allocate_fixed, channel_array, share_table
from marginloom.operators.cents import receiver, receivers_of, spread_in_cents
from marginloom.operators.joins import left_join_keyed
from marginloom.operators.report import pivot_report
from marginloom.operators.validity import holds_on, in_force, is_dated, join_rules
from marginloom.sources import rules as kinds
from marginloom.sources.rules import dates_of, rules_of
from marginloom.staging import staged
from marginloom.types import ALLOCATED, QUANTITY, SHARE, cast, money, quantity, text, texts

# Channels, the marker of shared costs, report sections, account types.
B2B, RETAIL, CLUB, UNALLOCATED = "B2B", "Retail", "Costco", "Unallocated"
PRO_RATA = "ProRataAlloc"
SALES_CHANNELS = [B2B, RETAIL, CLUB]
COMMISSION_CHANNELS = [B2B, RETAIL]
REPORT_CHANNELS = [B2B, RETAIL, CLUB, UNALLOCATED]
OPERATING_INCOME = "1. Operating Income"
COST_OF_GOODS = "2. Cost of Goods Sold"
OPERATING_EXPENSE = "3. Operating Expense"
OTHER_INCOME = "4. Non Operating Income"
OTHER_EXPENSE = "5. Non Operating Expense"
NET = "6. Net Profit/Loss"
NET_ACCOUNT = "Net Profit/Loss"
INCOME_TYPES = ["Income", "Other Income"]
REVENUE_TYPES = ["Income", "Cost Of Goods Sold", "Other Income"]
INVOICE, CREDIT_NOTE = "invoice", "creditnote"
# Rule types that take an account out of the general expense split.
RULED_EXPENSES = ["payroll_pct", "ad_pct", "payment_account", "commission_fee", "unalloc_opex"]
# Shares of the older statement.
OLD_SHARES = {B2B: "0.372511", RETAIL: "0.499460", CLUB: "0.128029"}
OLD_PAYROLL_SHARES = {B2B: "0.390278", RETAIL: "0.448611", CLUB: "0.161111"}
OLD_COMMISSION_SHARES = {RETAIL: "1"}

NO_SELLER = "coalesce(sales_person_id, '') = ''"
DATE = "transaction_date"
PL_COLUMNS = ["pl_section", "account_name", DATE, "amount", "channel"]
# A day's sum times a share, exact to the last of its 16 decimals: sums below 10**20, shares below 10.
DAY_SUM, DAY_SHARE = "DECIMAL(24,4)", "DECIMAL(13,12)"
# Quantities of a channel and product, and prices, whose product is exact: below 10**16 and 10**9.
SOLD, PRICE = "DECIMAL(22,6)", "DECIMAL(15,6)"


@dataclass(frozen=True)
class BlankSellerRules:
    """Channel of a document without salesperson: by order-number prefix, else by default."""

    # Prefixes of the order number, tried in this order.
    prefixes: tuple[tuple[str, str], ...] = field(
        default=(("0089400", CLUB), ("SO-EB-", RETAIL), ("SO-MB-", RETAIL))
    )
    invoice: str = B2B
    credit_note: str = RETAIL
    other_seller: str = RETAIL

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with whatever ``branches`` refers to."""
        return rows

    def branches(self) -> str:
        """CASE branches for a known document that no salesperson rule covers."""
        return (
            f"WHEN {NO_SELLER} AND document = {text(CREDIT_NOTE)} THEN {text(self.credit_note)} "
            f"{prefix_branches('so_number', self.prefixes, NO_SELLER + ' AND ')} "
            f"WHEN {NO_SELLER} THEN {text(self.invoice)} ELSE {text(self.other_seller)}"
        )

    @staticmethod
    def from_rules(rules: DataFrame) -> "TableSellerRules":
        """The same rules read from the ``so_prefix`` and ``default_channel`` rows."""
        base = BlankSellerRules()
        fixed = ", ".join(f"named_struct('n', -{len(p)}, 'key', {text(p)}, 'channel', {text(c)})" for p, c in base.prefixes)
        listed = f"collect_list(struct(-length(key) AS n, key, channel)) FILTER (WHERE type = {text(kinds.SO_PREFIX)})"
        one = rules.agg(
            F.expr(f"if(count_if(type = {text(kinds.SO_PREFIX)}) > 0, array_sort({listed}), array({fixed})) AS prefixes"),
            *[
                F.expr(
                    f"coalesce(max(channel) FILTER (WHERE type = {text(kinds.DEFAULT_CHANNEL)} AND key = {text(key)}), "
                    f"{text(default)}) AS {name}"
                )
                for name, key, default in (
                    ("invoice", "blank_sp_invoice", base.invoice),
                    ("credit_note", "blank_sp_creditnote", base.credit_note),
                    ("other_seller", "other_sp", base.other_seller),
                )
            ],
        )
        return TableSellerRules(one.selectExpr("struct(prefixes, invoice, credit_note, other_seller) AS blank"))


@dataclass(frozen=True)
class TableSellerRules:
    """The rules of ``BlankSellerRules`` as one row, longest prefix first; any number of them."""

    table: DataFrame

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_blank", self.table.scalar())

    def branches(self) -> str:
        fitting = "get(filter(_blank.prefixes, p -> startswith(so_number, p.key)), 0)"
        return (
            f"WHEN {NO_SELLER} AND document = {text(CREDIT_NOTE)} THEN _blank.credit_note "
            f"WHEN {NO_SELLER} THEN coalesce({fitting}.channel, _blank.invoice) ELSE _blank.other_seller"
        )


def invoice_bridge(invoices: DataFrame) -> DataFrame:
    """What the ledger needs of an invoice."""
    return invoices.select("invoice_id", "sales_person_id", "so_number")


def entity_bridge(bridge: DataFrame, credit_notes: DataFrame) -> DataFrame:
    """Invoices and credit notes under one entity id."""
    invoice = bridge.selectExpr(
        "invoice_id AS entity_id", "sales_person_id", "so_number", f"{text(INVOICE)} AS document"
    )
    credit = credit_notes.selectExpr(
        "creditnote_id AS entity_id", "sales_person_id", "'' AS so_number", f"{text(CREDIT_NOTE)} AS document"
    )
    return invoice.unionByName(credit)


def posted(ledger: DataFrame, accounts: DataFrame, account_types: list[str]) -> DataFrame:
    """Ledger rows of the given account types with account name and type.

    The account list is reduced by type before the join, so ledger rows of other types are
    gone after it.
    """
    return ledger.join(accounts.where(f"account_type IN ({texts(account_types)})"), "account_id", "inner")


def classify(rows: DataFrame) -> DataFrame:
    """Adds the report section and the signed amount: income as credit, cost as debit."""
    section = f"""CASE account_type WHEN 'Income' THEN {text(OPERATING_INCOME)}
        WHEN 'Cost Of Goods Sold' THEN {text(COST_OF_GOODS)} WHEN 'Other Income' THEN {text(OTHER_INCOME)} END"""
    signed = f"if(account_type IN ({texts(INCOME_TYPES)}), credit_minus_debit, debit_minus_credit)"
    return rows.selectExpr("*", f"{section} AS pl_section", f"{money(signed)} AS amount")


def _dated_for(rules: DataFrame, rows: DataFrame, day: str = DATE) -> DataFrame:
    """Dated rules cut to the days of ``rows``; others as they are."""
    return in_force(rules, rows, day) if is_dated(rules) else rules


def _with_seller_rules(rows: DataFrame, rules: DataFrame, day: str = DATE) -> DataFrame:
    by_seller = rules_of(rules, kinds.SALESPERSON, "key AS sales_person_id", "channel AS seller_channel")
    return join_rules(rows, by_seller, ["sales_person_id"], "left", day)


def _with_row_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Ledger rows with the rules on their account, vendor and entity type.

    The rules join after the accounts: joined into the accounts first, they would hide from
    Spark's estimate how small the chart of accounts is, and the ledger would be shuffled.
    """
    by_account = rules_of(rules, kinds.CLUB_ACCOUNT, "key AS account_name", "channel AS account_channel")
    kept_out = rules_of(rules, kinds.COGS_UNALLOCATED, "key AS account_name", "TRUE AS keeps_cost")
    kept_kinds = rules_of(rules, kinds.COGS_UNALLOCATED, "key AS entity_type", "TRUE AS keeps_kind")
    by_vendor = rules_of(rules, kinds.VENDOR, "key AS vendor_id", "channel AS vendor_channel")
    for table, key in ((by_account, "account_name"), (kept_out, "account_name"), (kept_kinds, "entity_type"), (by_vendor, "vendor_id")):
        rows = join_rules(rows, table, [key], "left", DATE)
    return rows


def channel_case(blank: BlankSellerRules | TableSellerRules = BlankSellerRules()) -> str:
    """The channel of an income or cost row, by priority.

    Without a known document: account rule, vendor rule, shared cost of goods, unallocated.
    With one: salesperson rule, then the rules for a blank salesperson. A rule can keep a cost
    row from being shared by its account or its entity type; a row whose entity type is NULL is
    not shared either and stays unallocated.
    """
    shared_cost = (
        "account_type = 'Cost Of Goods Sold' AND keeps_cost IS NULL AND keeps_kind IS NULL AND entity_type IS NOT NULL"
    )
    return (
        "CASE WHEN document IS NULL AND account_channel IS NOT NULL THEN account_channel "
        "WHEN document IS NULL AND vendor_channel IS NOT NULL THEN vendor_channel "
        f"WHEN document IS NULL AND {shared_cost} THEN {text(PRO_RATA)} "
        f"WHEN document IS NULL THEN {text(UNALLOCATED)} "
        "WHEN seller_channel IS NOT NULL THEN seller_channel "
        f"{blank.branches()} END"
    )


def channel_revenue(
    ledger: DataFrame,
    accounts: DataFrame,
    bridge: DataFrame,
    rules: DataFrame,
    blank: BlankSellerRules | TableSellerRules = BlankSellerRules(),
    few_documents: bool = False,
) -> DataFrame:
    """Income and cost-of-goods rows of the ledger with their channel; shared costs are marked.

    ``few_documents``: the rows of ``bridge`` are counted and so few that they may be broadcast.
    """
    rules = _dated_for(rules, ledger)
    rows = _with_row_rules(classify(posted(ledger, accounts, REVENUE_TYPES)), rules)
    # a large part of the ledger has no entity: adaptive execution splits the left side
    sized = F.broadcast if few_documents else lambda df: df
    if is_dated(rules):
        rows = _with_seller_rules(rows.join(sized(bridge), "entity_id", "left"), rules)
    else:
        rows = rows.join(sized(_with_seller_rules(bridge, rules)), "entity_id", "left")
    rows = blank.attach(rows)
    return rows.selectExpr(*PL_COLUMNS[:4], f"{channel_case(blank)} AS channel")


def avg_po_cost(po_items: DataFrame) -> DataFrame:
    """Average purchase price per product, weighted by quantity; NULL without quantity."""
    spent = f"CAST(sum({money('item_price')} * {quantity('quantity')}) AS DOUBLE)"
    bought = f"CAST(sum({quantity('quantity')}) AS DOUBLE)"
    average = cast(f"round(try_divide({spent}, {bought}), 6)", QUANTITY)
    return po_items.groupBy("product_id").agg(F.expr(f"{average} AS avg_cost"))


def channel_po_cost(lines: DataFrame, invoices: DataFrame, average: DataFrame, rules: DataFrame) -> DataFrame:
    """Purchase cost of invoiced quantities per channel of the salesperson.

    Quantities are summed per channel and product before the average cost is joined.
    """
    headers = invoices.select("invoice_id", "sales_person_id", *["invoice_date"] * is_dated(rules))
    invoiced = lines.select("invoice_id", "product_id", "quantity").join(headers, "invoice_id", "inner")
    sold = (
        _with_seller_rules(invoiced, _dated_for(rules, invoices, "invoice_date"), "invoice_date")
        .selectExpr(f"coalesce(seller_channel, {text(RETAIL)}) AS channel", "product_id", "quantity")
        .groupBy("channel", "product_id")
        .agg(F.expr(f"{cast(f'sum({quantity("quantity")})', SOLD)} AS _sold"))
    )
    cost = F.expr(f"sum(_sold * {cast('avg_cost', PRICE)}) AS total_cost")
    return sold.join(average, "product_id", "inner").groupBy("channel").agg(cost)


def revenue_shares(revenue: DataFrame, channels: list[str] = SALES_CHANNELS) -> DataFrame:
    """Share of each channel in operating income over all dates."""
    return share_table(revenue.where(f"pl_section = {text(OPERATING_INCOME)}"), channels)


def revenue_share_pairs(revenue: DataFrame) -> DataFrame:
    """``channel, share, commission_share``: both kinds of revenue shares from one sum over the ledger."""
    income = revenue.where(f"pl_section = {text(OPERATING_INCOME)}")
    return share_table(income, SALES_CHANNELS, also={"commission_share": COMMISSION_CHANNELS})


def po_cost_shares(po_cost: DataFrame, channels: list[str] = SALES_CHANNELS) -> DataFrame:
    """Share of each channel in purchase cost."""
    return share_table(po_cost, channels, "total_cost")


def allocate_cogs(revenue: DataFrame, shares: DataFrame) -> DataFrame:
    """Shared cost of goods spread over the channels by purchase cost."""
    shared = revenue.where(f"channel = {text(PRO_RATA)}")
    return allocate_by_share(shared, shares, SALES_CHANNELS).select(*PL_COLUMNS)


def expenses(ledger: DataFrame, accounts: DataFrame, account_type: str, section: str) -> DataFrame:
    """Expense rows of one account type: section, account, date, debit amount."""
    return posted(ledger, accounts, [account_type]).selectExpr(
        f"{text(section)} AS pl_section", "account_name", "transaction_date", f"{money('debit_minus_credit')} AS amount"
    )


def operating_expenses(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    return expenses(ledger, accounts, "Expense", OPERATING_EXPENSE)


def other_expenses(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    return expenses(ledger, accounts, "Other Expense", OTHER_EXPENSE)


def _with_rules(rows: DataFrame, rules: DataFrame, rule_type: str) -> DataFrame:
    listed = rules_of(_dated_for(rules, rows), rule_type, "key AS account_name", "channel", "value")
    return join_rules(rows, listed, ["account_name"], "inner", DATE)


def _without_rules(rows: DataFrame, rules: DataFrame, rule_types: list[str]) -> DataFrame:
    rules = _dated_for(rules, rows)
    ruled = rules.where(f"type IN ({texts(rule_types)})").selectExpr("key AS account_name", *dates_of(rules)).distinct()
    return join_rules(rows, ruled, ["account_name"], "left_anti", DATE)


def _with_amount(rows: DataFrame, amount: str) -> DataFrame:
    return rows.selectExpr(*PL_COLUMNS[:3], f"{cast(amount, ALLOCATED)} AS amount", "channel")


def allocate_static(rows: DataFrame, rules: DataFrame, rule_type: str) -> DataFrame:
    """Expense rows of ruled accounts, once per listed channel, times the listed share."""
    return _with_amount(_with_rules(rows, rules, rule_type), "amount * value")


def allocate_commission(rows: DataFrame, rules: DataFrame, shares: DataFrame) -> DataFrame:
    """Commission accounts to the channels listed for them, by the two-way revenue shares."""
    listed = _with_rules(rows, rules, kinds.COMMISSION).where(f"channel IN ({texts(COMMISSION_CHANNELS)})")
    return _with_amount(listed.join(F.broadcast(shares), "channel", "left"), "amount * share")


def allocate_other_opex(rows: DataFrame, rules: DataFrame, shares: DataFrame) -> DataFrame:
    """Expense accounts without any rule, by the three-way revenue shares."""
    return allocate_by_share(_without_rules(rows, rules, RULED_EXPENSES), shares, SALES_CHANNELS).select(*PL_COLUMNS)


def tag_unallocated(rows: DataFrame, rules: DataFrame, rule_type: str) -> DataFrame:
    """Accounts kept whole under the channel of their rule."""
    return _with_amount(_with_rules(rows, rules, rule_type), "amount")


def allocate_other_expense(rows: DataFrame, rules: DataFrame, shares: DataFrame) -> DataFrame:
    """Non-operating expense: kept accounts whole, the others by the three-way revenue shares."""
    spread = allocate_by_share(_without_rules(rows, rules, [kinds.OTHER_UNALLOCATED]), shares, SALES_CHANNELS)
    return spread.select(*PL_COLUMNS).unionByName(tag_unallocated(rows, rules, kinds.OTHER_UNALLOCATED))


def opex_alloc(rows: DataFrame, rules: DataFrame, shares: DataFrame, commission_shares: DataFrame) -> DataFrame:
    """Advertising, payment fees, commissions and all other allocated operating expense."""
    parts = [
        allocate_static(rows, rules, kinds.ADVERTISING),
        allocate_static(rows, rules, kinds.PAYMENT),
        allocate_commission(rows, rules, commission_shares),
        allocate_other_opex(rows, rules, shares),
    ]
    return reduce(DataFrame.unionByName, parts)


def channel_pl(revenue: DataFrame, *parts: DataFrame) -> DataFrame:
    """All parts of the statement in one table; shared cost markers give way to their allocation."""
    own = revenue.where(f"channel <> {text(PRO_RATA)}")
    return reduce(DataFrame.unionByName, [_with_amount(part, "amount") for part in (own, *parts)])


def net_profit(pl: DataFrame) -> DataFrame:
    """Income minus cost per date and channel."""
    signed = f"if(pl_section IN ({texts([OPERATING_INCOME, OTHER_INCOME])}), amount, -amount)"
    return (
        pl.groupBy("transaction_date", "channel")
        .agg(F.expr(f"sum({signed}) AS amount"))
        .selectExpr(
            f"{text(NET)} AS pl_section", f"{text(NET_ACCOUNT)} AS account_name", "transaction_date", "amount", "channel"
        )
    )


def with_net(pl: DataFrame) -> DataFrame:
    """The statement followed by its net rows; it is computed once, staged and read for both."""
    pl = staged(pl, "statement")
    return pl.unionByName(net_profit(pl))


def _spread_costs(revenue: DataFrame, po_shares: DataFrame, share: str = SHARE) -> DataFrame:
    """Income and cost rows, once per receiving channel; only shared costs have more than one."""
    receivers = f"if(channel = {text(PRO_RATA)}, {channel_array(SALES_CHANNELS)}, array(channel))"
    spread = revenue.selectExpr(*PL_COLUMNS[:4], f"channel = {text(PRO_RATA)} AS shared", f"explode({receivers}) AS channel")
    part = f"CAST(if(shared, share, 1) AS {share})"
    return _with_amount(spread.join(F.broadcast(po_shares), "channel", "left"), f"amount * {part}")


def _expense_rows(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Expense rows of both kinds in one pass over the ledger."""
    section = f"if(account_type = 'Expense', {text(OPERATING_EXPENSE)}, {text(OTHER_EXPENSE)})"
    return posted(ledger, accounts, ["Expense", "Other Expense"]).selectExpr(
        "account_name", f"{section} AS pl_section", "transaction_date", f"{money('debit_minus_credit')} AS amount"
    )


def all_expenses(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """``operating_expenses`` and ``other_expenses`` in one pass over the ledger."""
    return _expense_rows(ledger, accounts).select(*PL_COLUMNS[:4])


def _spread_expenses(rows: DataFrame, rules: DataFrame, shares: DataFrame, share: str = SHARE) -> DataFrame:
    """Expense rows, each once per receiving channel.

    Listed accounts get the listed value, or the two-way revenue share (commissions), or the whole
    amount (kept accounts), once per rule; accounts without a rule get the three-way revenue shares.
    """
    by_type = f"""CASE WHEN type IN ({texts(RULED_EXPENSES)}) THEN {text(OPERATING_EXPENSE)}
        WHEN type = {text(kinds.OTHER_UNALLOCATED)} THEN {text(OTHER_EXPENSE)} END"""
    ruled = rules.selectExpr(
        "key AS account_name", f"{by_type} AS pl_section", "type", "channel AS listed", "value", *dates_of(rules)
    )
    ruled = ruled.where("pl_section IS NOT NULL")
    kept_whole = texts([kinds.OPEX_UNALLOCATED, kinds.OTHER_UNALLOCATED])
    part = f"""CASE WHEN type IS NULL THEN share WHEN type = {text(kinds.COMMISSION)} THEN commission_share
        WHEN type IN ({kept_whole}) THEN 1 ELSE value END"""
    payable = f"type IS NULL OR type <> {text(kinds.COMMISSION)} OR listed IN ({texts(COMMISSION_CHANNELS)})"
    receivers = f"if(type IS NULL, {channel_array(SALES_CHANNELS)}, array(listed))"
    spread = (
        join_rules(rows, ruled, ["account_name", "pl_section"], "left", DATE)
        .where(payable)
        .selectExpr(*PL_COLUMNS[:4], "type", "value", f"explode({receivers}) AS channel")
    )
    return _with_amount(spread.join(F.broadcast(shares), "channel", "left"), f"amount * {cast(part, share)}")


def channel_statement(
    ledger: DataFrame,
    accounts: DataFrame,
    bridge: DataFrame,
    rules: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    po_items: DataFrame,
    blank: BlankSellerRules | TableSellerRules = BlankSellerRules(),
) -> DataFrame:
    """``channel_pl`` of all parts with three passes over the ledger instead of one per part.

    Income and cost rows pass once for the rows and once for the revenue shares of all dates,
    expense rows once, with the rules of their account joined to them.
    """
    revenue = channel_revenue(ledger, accounts, bridge, rules, blank)
    po_shares = po_cost_shares(channel_po_cost(lines, invoices, avg_po_cost(po_items), rules))
    expense = _spread_expenses(
        _expense_rows(ledger, accounts), _dated_for(rules, ledger), revenue_share_pairs(revenue)
    )
    return _spread_costs(revenue, po_shares).unionByName(expense)


def _by_day(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, DATE).agg(F.expr(f"{cast('sum(amount)', DAY_SUM)} AS amount"))


def revenue_by_day(revenue: DataFrame) -> DataFrame:
    """Income and cost per section, channel and day; days can be summed by themselves."""
    return _by_day(revenue, "pl_section", "channel")


def expenses_by_day(expense: DataFrame) -> DataFrame:
    """Expenses of ``all_expenses`` per section, account and day; days can be summed by themselves."""
    return _by_day(expense, "pl_section", "account_name")


def net_from_days(revenue_days: DataFrame, expense_days: DataFrame, rules: DataFrame, po_shares: DataFrame) -> DataFrame:
    """``net_profit`` from the day sums alone; no ledger row is read. Dated rules are cut to the expense days."""
    days = revenue_days.selectExpr("*", f"{text(NET_ACCOUNT)} AS account_name")
    shares = revenue_share_pairs(revenue_days)
    expense = _spread_expenses(expense_days, _dated_for(rules, expense_days), shares, DAY_SHARE)
    return net_profit(_spread_costs(days, po_shares, DAY_SHARE).unionByName(expense))


def net_statement(
    ledger: DataFrame,
    accounts: DataFrame,
    bridge: DataFrame,
    rules: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    po_items: DataFrame,
    blank: BlankSellerRules | TableSellerRules = BlankSellerRules(),
) -> DataFrame:
    """``net_profit`` of ``channel_statement`` without spreading a single ledger row.

    A share is the same for all rows of a channel, so rows are summed to days first (income and
    cost per section and channel, expenses per section and account) and the sums are spread.
    """
    revenue = channel_revenue(ledger, accounts, bridge, rules, blank)
    po_shares = po_cost_shares(channel_po_cost(lines, invoices, avg_po_cost(po_items), rules))
    days = revenue_by_day(revenue).selectExpr("*", f"{text(NET_ACCOUNT)} AS account_name")
    spent = expenses_by_day(_expense_rows(ledger, accounts))
    expense = _spread_expenses(spent, _dated_for(rules, ledger), revenue_share_pairs(revenue), DAY_SHARE)
    return net_profit(_spread_costs(days, po_shares, DAY_SHARE).unionByName(expense))


def _listed_receivers(rules: DataFrame) -> DataFrame:
    """Expense rules as one row per account and section, with all that is listed for it."""
    section = f"""CASE WHEN type IN ({texts(RULED_EXPENSES)}) THEN {text(OPERATING_EXPENSE)}
        WHEN type = {text(kinds.OTHER_UNALLOCATED)} THEN {text(OTHER_EXPENSE)} END"""
    whole = f"type IN ({texts([kinds.OPEX_UNALLOCATED, kinds.OTHER_UNALLOCATED])})"
    one = f"struct(type, {receiver('channel', f'if({whole}, 1, value)')} AS r{''.join(f', {c}' for c in dates_of(rules))}) AS l"
    listed = rules.selectExpr("key AS account_name", f"{section} AS pl_section", one).where("pl_section IS NOT NULL")
    return listed.groupBy("account_name", "pl_section").agg(F.expr("collect_list(l) AS listed"))


def expense_cents(ledger: DataFrame, accounts: DataFrame, rules: DataFrame, revenue: DataFrame) -> DataFrame:
    """Expense rows in whole cents, once per receiving channel; the parts of each row sum to its rounded amount.

    An account with rules of several types is spread once for each type.
    """
    pairs = revenue_share_pairs(revenue)
    rows = _expense_rows(ledger, accounts).join(_listed_receivers(rules), ["account_name", "pl_section"], "left")
    both = receivers_of(pairs, three="share", two="commission_share").selectExpr("struct(three, two) AS shares")
    rows = rows.withColumn("shares", both.scalar()).selectExpr("*", "shares.three AS three", "shares.two AS two")
    holding = f"filter(listed, l -> {holds_on(DATE, 'l.valid_from', 'l.valid_to')})" if is_dated(rules) else "listed"
    rows = rows.selectExpr(*PL_COLUMNS[:4], "three", "two", f"coalesce({holding}, array()) AS listed")
    types = "explode(if(size(listed) = 0, array(CAST(NULL AS STRING)), array_distinct(transform(listed, l -> l.type)))) AS type"
    rows = rows.selectExpr("*", types)
    receivers = f"""CASE WHEN type IS NULL THEN three
        WHEN type = {text(kinds.COMMISSION)} THEN filter(two, s -> exists(listed, l -> l.type = type AND l.r.channel = s.channel))
        ELSE transform(filter(listed, l -> l.type = type AND l.r.share IS NOT NULL), l -> l.r) END"""
    chosen = rows.selectExpr(*PL_COLUMNS[:4], f"{receivers} AS receivers")
    return spread_in_cents(chosen, "receivers", UNALLOCATED).select(*PL_COLUMNS)


def revenue_cents(revenue: DataFrame, po_shares: DataFrame) -> DataFrame:
    """Income and cost rows in whole cents; shared costs once per channel, by purchase cost."""
    rows = revenue.withColumn("shared", receivers_of(po_shares, shared="share").scalar())
    receivers = f"if(channel = {text(PRO_RATA)}, shared, array({receiver('channel', '1')}))"
    chosen = rows.selectExpr(*PL_COLUMNS[:4], f"{receivers} AS receivers")
    return spread_in_cents(chosen, "receivers", UNALLOCATED).select(*PL_COLUMNS)


def statement_in_cents(
    ledger: DataFrame,
    accounts: DataFrame,
    bridge: DataFrame,
    rules: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    po_items: DataFrame,
    blank: BlankSellerRules | TableSellerRules = BlankSellerRules(),
) -> DataFrame:
    """``channel_statement`` in whole cents: the parts of every ledger row sum to its rounded amount.

    Where no channel has a share (no income, no purchase cost), the row stays whole and unallocated.
    """
    revenue = channel_revenue(ledger, accounts, bridge, rules, blank)
    po_shares = po_cost_shares(channel_po_cost(lines, invoices, avg_po_cost(po_items), rules))
    return revenue_cents(revenue, po_shares).unionByName(expense_cents(ledger, accounts, rules, revenue))


def rounded_sources(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Section, account and amount of every posted ledger row, each rounded to cents: what a statement must sum to."""
    rows = classify(posted(ledger, accounts, [*REVENUE_TYPES, "Expense", "Other Expense"]))
    spent = f"CASE account_type WHEN 'Expense' THEN {text(OPERATING_EXPENSE)} WHEN 'Other Expense' THEN {text(OTHER_EXPENSE)} END"
    return rows.selectExpr(f"coalesce(pl_section, {spent}) AS pl_section", "account_name", "round(amount, 2) AS amount")


def report_channels(rules: DataFrame) -> list[str]:
    """The channels a statement can have: the fixed ones, then those that only rules name, in order.

    One name per column of the pivot comes to the driver.
    """
    named = rules.where(f"channel IS NOT NULL AND channel NOT IN ({texts(REPORT_CHANNELS)})").select("channel").distinct()
    return REPORT_CHANNELS + sorted(r["channel"] for r in named.collect())


def profitability_pivot(
    pl: DataFrame,
    first: dt.date | str | None = None,
    last: dt.date | str | None = None,
    channels: list[str] | None = None,
) -> DataFrame:
    """Section x account by channel, sums of the chosen dates.

    ``channels`` come from ``report_channels``; a channel of the statement that isn't listed stops the job.
    """
    dates = ("transaction_date", first, last) if first is not None and last is not None else None
    columns = channels or REPORT_CHANNELS
    return pivot_report(pl, ["pl_section", "account_name"], "channel", columns, "amount", "sum", date_range=dates)


# --- older rules, kept for statements of earlier periods ---


def assign_channel_basic(
    ledger: DataFrame,
    accounts: DataFrame,
    invoices: DataFrame,
    b2b_sellers: list[str],
    club_sellers: list[str],
    blank: BlankSellerRules = BlankSellerRules(),
) -> DataFrame:
    """Income and cost rows with a channel from the invoice alone: listed sellers, prefixes, defaults."""
    bridge = invoice_bridge(invoices).selectExpr(
        "invoice_id AS entity_id", "sales_person_id", "so_number", f"{text(INVOICE)} AS document"
    )
    rows = left_join_keyed(classify(posted(ledger, accounts, REVENUE_TYPES)), bridge, "entity_id")
    channel = (
        f"CASE WHEN document IS NULL THEN {text(UNALLOCATED)} "
        f"WHEN sales_person_id IN ({texts(b2b_sellers)}) THEN {text(B2B)} "
        f"WHEN sales_person_id IN ({texts(club_sellers)}) THEN {text(CLUB)} "
        f"{blank.branches()} END"
    )
    return rows.selectExpr(*PL_COLUMNS[:4], f"{channel} AS channel")


def fixed_split(
    rows: DataFrame,
    shares: dict[str, str] = OLD_SHARES,
    include: list[str] | None = None,
    include_prefixes: tuple[str, ...] = (),
    exclude: list[str] | None = None,
    exclude_prefixes: tuple[str, ...] = (),
) -> DataFrame:
    """Expense rows split by constant shares, for accounts chosen by name or name prefix."""

    def named(names: list[str] | None, prefixes: tuple[str, ...]) -> str:
        hits = [f"account_name IN ({texts(names or [])})", *[f"startswith(account_name, {text(p)})" for p in prefixes]]
        return f"coalesce({' OR '.join(hits)}, FALSE)"

    if include is not None or include_prefixes:
        rows = rows.where(named(include, include_prefixes))
    if exclude is not None or exclude_prefixes:
        rows = rows.where(f"NOT {named(exclude, exclude_prefixes)}")
    return allocate_fixed(rows, shares).select(*PL_COLUMNS)
