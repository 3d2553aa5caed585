"""Cash-management report files: header codes 01/02/03, transactions 16, continuations 88.

Headers apply to the lines below them. One shuffle puts each block of a file (a split, a key range) in order; there,
continuations join their record and headers are carried to the records below. Each block leaves a summary: the headers in
force at its end, and the continuations before its first record. Summaries are scanned in block order, and what a
block inherits is joined to its rows, which are not shuffled again. A new group header replaces the group but leaves
the account in force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.arrays import balance_map, debit_credit
from tidemark.functions.coercion import implied_cents
from tidemark.functions.dates import yymmdd
from tidemark.functions.text import narrative_fields
from tidemark.operators.ordering import inherited, tasks_for
from tidemark.session import cut_lineage, small_side


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def _at(i: int) -> Column:
    return F.get("f", F.lit(i))


def records(lines: DataFrame) -> DataFrame:
    """(file, block, seq, no, code, f, content, continuations, key): the records of each block with their 88 lines, and a record
    number 0 of the continuations before the block's first record. Partitioned by `key`, the file and block."""
    text = F.rtrim("line")
    full = lines.filter(F.trim("line") != "").select(
        "file", "block", "seq", F.struct("file", "block").alias("key"),
        F.trim(F.regexp_replace(F.substring_index(text, ",", 1), "/+$", "")).alias("code"),
        F.when(text.contains(","), F.rtrim(F.regexp_replace(F.substr(text, F.instr(text, ",") + 1), r"/\s*$", ""))).otherwise("").alias("content"),
    ).repartition(tasks_for(lines), "key")
    continues = F.col("code") == "88"
    inside = Window.partitionBy("key").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    numbered = full.withColumn("no", F.sum(F.when(continues, 0).otherwise(1)).over(inside))
    # One record is one output value, so gathering its lines is bounded by the record.
    later = F.sort_array(F.collect_list(F.when(continues, F.struct("seq", "content"))))
    head = F.min(F.when(~continues, F.struct("seq", "code", "content"))).alias("h")
    gathered = numbered.groupBy("key", "no").agg(head, F.transform(later, lambda x: x["content"]).alias("continuations"))
    fields = F.transform(F.split("h.content", ","), lambda x: F.trim(x))
    return gathered.select("key.file", "key.block", "h.seq", "no", "h.code", fields.alias("f"), "h.content", "continuations", "key")


def _placed(lines: DataFrame) -> DataFrame:
    """Records with the headers that their own block has above them, and whether they are its last. Written once."""
    rows = records(lines)
    file_head = F.struct(
        _at(0).alias("sender_id"), _at(1).alias("receiver_id"), yymmdd(_at(2)).alias("file_date"), _at(3).alias("file_creation_time")
    )
    group_head = F.struct(
        _at(1).alias("originator_id"), yymmdd(_at(3)).alias("as_of_date"), _at(4).alias("as_of_time"), _at(5).alias("currency")
    )
    own_segment = F.concat_ws(",", F.slice("f", F.lit(3), F.greatest(F.size("f") - 2, F.lit(0))))
    pieces = F.when(F.col("code") == "03", F.concat(F.array(own_segment), F.col("continuations")))
    inside = Window.partitionBy("key").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    headed = rows.withColumns(
        {
            "file_ctx": F.last(F.when(F.col("code") == "01", file_head), True).over(inside),
            "group_ctx": F.last(F.when(F.col("code") == "02", group_head), True).over(inside),
            "pieces": pieces,
            "last": F.lead("no").over(Window.partitionBy("key").orderBy("no")).isNull(),
        }
    )
    # An account keeps the currency of the group it was opened in, which may stand in an earlier block.
    account_head = F.struct(
        _at(0).alias("bank_account_number"), _blank_to_null(_at(1)).alias("currency"), F.col("group_ctx").isNull().alias("group_before"),
        _blank_to_null(F.col("group_ctx.currency")).alias("group_currency"), balance_map(F.col("pieces")).alias("balances"),
    )
    accounts = headed.withColumn("account_ctx", F.last(F.when(F.col("code") == "03", account_head), True).over(inside))
    return cut_lineage(accounts.filter("last OR no = 0 OR code = '16'").withColumn("pieces", F.when(F.col("last"), F.col("pieces"))))


def _currency(account: str, group: Column) -> Column:
    """An account's own currency, or that of the group it was opened in, given the group in force before its block."""
    at = lambda name: F.col(f"{account}.{name}")
    return F.coalesce(at("currency"), F.when(at("group_before"), group).otherwise(at("group_currency")))


def _inheritance(placed: DataFrame) -> DataFrame:
    """For each block: the file, group and account in force before it, and the continuations that later blocks have for
    its last record. One row per block."""
    summary = placed.groupBy("key").agg(
        F.max(F.col("no") > 0).alias("has_record"),
        F.max_by("continuations", F.when(F.col("no") == 0, 1)).alias("leading"),
        *[F.max_by(c, F.when(F.col("last"), 1)).alias(c) for c in ("file_ctx", "group_ctx", "account_ctx", "pieces")],
    )
    summary = cut_lineage(summary.select("key.file", "key.block", "key", *[c for c in summary.columns if c != "key"]))
    owner = {"owner": F.when(F.col("has_record"), F.col("key"))}
    tails = inherited(summary, ["file"], "block", owner).filter("leading IS NOT NULL AND owner IS NOT NULL").groupBy(F.col("owner").alias("key")).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "leading"))), lambda p: p["leading"])).alias("more")
    )
    whole = inherited(summary.join(tails, "key", "left"), ["file"], "block", {"in_file": F.col("file_ctx"), "in_group": F.col("group_ctx")})
    account = F.col("account_ctx")
    balances = F.when(F.col("pieces").isNotNull() & F.col("more").isNotNull(), balance_map(F.concat("pieces", "more"))).otherwise(account["balances"])
    resolved = F.when(account.isNotNull(), F.struct(
        account["bank_account_number"].alias("bank_account_number"), _currency("account_ctx", _blank_to_null(F.col("in_group.currency"))).alias("currency"), balances.alias("balances")))
    return inherited(whole.withColumn("resolved", resolved), ["file"], "block", {"in_account": F.col("resolved")}).select("key", "in_file", "in_group", "in_account", "more")


def transactions(lines: DataFrame) -> DataFrame:
    """One row per transaction with the file, group and account it stands under."""
    placed = _placed(lines)
    detail = placed.filter(F.col("code") == "16").join(small_side(_inheritance(placed)), "key", "left")
    own = F.col("account_ctx").isNotNull()
    account = lambda name: F.when(own, F.col(f"account_ctx.{name}")).otherwise(F.col(f"in_account.{name}"))
    head = lambda kind, name: F.coalesce(F.col(f"{kind}_ctx"), F.col(f"in_{kind}"))[name]
    currency = F.when(own, _currency("account_ctx", _blank_to_null(F.col("in_group.currency")))).otherwise(F.col("in_account.currency"))
    continuations = F.when(F.col("last") & F.col("more").isNotNull(), F.concat("continuations", "more")).otherwise(F.col("continuations"))
    funds = _at(2)
    base = F.when(funds == "S", 6).when(funds.isin("D", "V"), 5).otherwise(3)
    day = lambda i: F.when(funds == "S", implied_cents(_at(i)))
    ref = lambda k: _blank_to_null(F.get("f", base + k))
    inline = F.concat_ws(",", F.slice("f", base + 3, F.greatest(F.size("f") - base - 2, F.lit(0))))
    pieces = F.filter(F.concat(F.array(F.trim(inline)), continuations), lambda p: F.trim(p) != "")
    flat = detail.select(
        "file", "block", "seq",
        head("file", "sender_id").alias("sender_id"), head("file", "receiver_id").alias("receiver_id"),
        head("file", "file_date").alias("file_date"), head("file", "file_creation_time").alias("file_creation_time"),
        head("group", "originator_id").alias("originator_id"), head("group", "as_of_date").alias("as_of_date"), head("group", "as_of_time").alias("as_of_time"),
        account("bank_account_number").alias("bank_account_number"), F.coalesce(currency, head("group", "currency")).alias("currency"),
        _at(0).alias("type_code"), implied_cents(_at(1)).alias("amount"), debit_credit(_at(0)).alias("debit_credit_mark"),
        funds.alias("funds_type"), day(3).alias("same_day_amount"), day(4).alias("one_day_amount"),
        day(5).alias("two_plus_day_amount"), ref(0).alias("bank_reference"), ref(1).alias("customer_reference"),
        _blank_to_null(F.trim(F.concat_ws(" ", pieces))).alias("description"), account("balances").alias("balances"),
    )
    fields = narrative_fields(flat, "description")
    return fields.select(*[c for c in fields.columns if c != "balances"], "balances")


def wide_balances(rows: DataFrame, codes: list[str]) -> DataFrame:
    """Balance map to one column per listed code."""
    return rows.select(
        *[c for c in rows.columns if c != "balances"],
        *[F.try_element_at("balances", F.lit(c)).alias(f"balance_{c}") for c in codes],
    )
