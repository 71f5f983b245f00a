"""Preparing datasets: reject routing, splits, samples, chat forms, masks, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselattice import schema
from caselattice.functions import text as tx

ROLES = ("system", "user", "assistant")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``copy``: 1 for the first row of each key, 2 for the next."""
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last one's values at the first one's place."""
    others = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.min(order).alias(order), F.max_by(F.struct(*others), order).alias("v")).select(key, order, "v.*")


def split_tables(rows: DataFrame, part: str = "part") -> dict[str, DataFrame]:
    """The rows of each part, and all of them again as one, without the column that names it."""
    parts = {name: rows.where(F.col(part) == name).drop(part) for name in ("train", "eval", "test")}
    return parts | {"all": parts["train"].unionByName(parts["eval"]).unionByName(parts["test"])}


def conversion_report(report: DataFrame, sources: dict[str, dict]) -> dict:
    """The counts of a conversion with what is known of its inputs: for each its path, encoding, delimiter, bytes and
    SHA-256 (`files.source_facts`), and when it was made."""
    counts = report.first().asDict()
    return {"created_at": report.sparkSession.range(1).select(tx.stamp()).first()[0], "sources": sources, "statistics": counts}


def convert_commands(commands: DataFrame, categories: DataFrame, include_deleted: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, rejects, report) of device commands met with their categories.

    Both inputs have row_number. A row is judged in this order: deleted, without id, repeated id, category missing or
    deleted; a row without category still takes its id. The repeated ids themselves are among the rejects.
    """
    deleted = F.lit(False) if include_deleted else tx.is_true("deleted")
    cats = categories.select(tx.clean("dev_cat_id").alias("cat"), "row_number", deleted.alias("gone"), *[tx.clean(c).alias(c) for c in ("dev_cat_name", "dev_cat_desc", "device_cat_code", "device_cat_alias")]).where("cat <> ''")
    numbered = first_wins(cats.where("NOT gone"), ["cat"], ["row_number"])
    own = commands.select(
        "row_number", deleted.alias("gone"), tx.clean("device_command_id").alias("command"), tx.clean("dev_cat_id").alias("cat"),
        *[tx.clean(c).alias(c) for c in ("command_desc", "command_code", "param_type", "param_desc")],
    )
    live = own.where("NOT gone")
    # rows without an id are never compared, so they do not meet in one task
    blank = live.where("command = ''").withColumn("copy", F.lit(1))
    first = first_wins(live.where("command <> ''"), ["command"], ["row_number"]).unionByName(blank)
    met = first.join(numbered.where("copy = 1").drop("row_number", "gone", "copy").withColumn("has", F.lit(True)), "cat", "left")
    reason = F.when(F.col("command") == "", "missing_device_command_id").when(F.col("copy") > 1, "duplicate_device_command_id").when(F.col("has").isNull(), "dev_cat_id_not_found_or_deleted")
    judged = met.withColumn("reason", reason)
    filled = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))
    records = judged.where("reason IS NULL").select(
        F.col("command").alias("设备指令主键"), filled("command_code", "command").alias("设备指令号"), filled("dev_cat_name", "device_cat_alias", "device_cat_code", "cat").alias("设备类型"),
        F.lit("").alias("设备单元号"), F.col("command_desc").alias("设备指令功能说明"), F.to_json(F.struct("param_type", "param_desc")).alias("设备参数"), F.col("cat").alias("设备类别主键"),
        F.col("device_cat_code").alias("设备类别编码"), F.col("device_cat_alias").alias("设备类别别名"), F.col("dev_cat_desc").alias("设备类别描述"), F.col("param_type").alias("参数类型"), F.col("param_desc").alias("参数描述"),
        tx.searchable(["dev_cat_name", "device_cat_alias", "dev_cat_desc", "device_cat_code", "cat", "command_desc", "command_code", "command", "param_type", "param_desc"]).alias("_text"),
    )
    rejects = judged.where("reason IS NOT NULL").select(
        F.col("row_number").alias("row"), "reason", F.when(F.col("reason") != "missing_device_command_id", F.col("command")).alias("device_command_id"), F.when(F.col("reason") == "dev_cat_id_not_found_or_deleted", F.col("cat")).alias("dev_cat_id")
    )
    one = lambda df, *c: df.agg(*c)
    report = (
        one(own, F.count(F.lit(1)).alias("command_rows"), F.count_if("gone").alias("deleted_commands"))
        .join(one(cats, F.count_if("gone").alias("deleted_categories")))
        .join(one(judged, F.count_if(F.col("reason").isNull()).alias("records"), F.count_if(F.col("reason").isNotNull()).alias("rejected"), F.count_if(F.col("reason") == "dev_cat_id_not_found_or_deleted").alias("orphans"), F.count_if(F.col("reason").isNull() & (F.col("command_code") == "")).alias("code_fallbacks"), F.countDistinct(F.when(F.col("reason") == "duplicate_device_command_id", F.col("command"))).alias("n_duplicate_ids")))
    )
    return records.orderBy("设备类别主键", "设备指令主键"), rejects, report


def join_texts(truth: DataFrame, texts: DataFrame, least_rows: int = 1) -> tuple[DataFrame, DataFrame]:
    """(samples, counters): tables with enough rows met with their texts; rows are tested before texts are looked up."""
    long_enough = F.coalesce(F.size("rows"), F.lit(0)) >= least_rows
    met = truth.withColumn("short", ~long_enough).join(texts.select("id", "content"), "id", "left")
    counters = met.agg(F.count_if("short").alias("too_short"), F.count_if(~F.col("short") & F.col("content").isNull()).alias("no_text"), F.count_if(~F.col("short") & F.col("content").isNotNull()).alias("samples"))
    return met.where(~F.col("short") & F.col("content").isNotNull()).drop("short"), counters


def split_part(place: Column, n: Column, train: float = 0.8, evaluation: float = 0.1) -> Column:
    """train, eval or test by place (from 1) in a stratum of n: at least one of train, then eval, then test."""
    first, second = F.greatest(F.lit(1), F.floor(n * train)), F.greatest(F.lit(1), F.floor(n * evaluation))
    tight = n - first - second < 1
    first_, second_ = F.when(tight, F.greatest(F.lit(1), n - 2)).otherwise(first), F.lit(0)
    second_ = F.when(tight, F.greatest(F.lit(1), n - first_ - 1)).otherwise(second)
    return F.when(place <= first_, "train").when(place <= first_ + second_, "eval").otherwise("test")


def hashed_places(rows: DataFrame, stratum: str, key: str, seed: int) -> DataFrame:
    """Adds place (from 1) and stratum_rows: rows of each stratum in the order of a hash of seed and key.

    The hash's first byte parts a stratum into 256 runs that are ranked apart; the counts of the runs before give each
    run's start. So a stratum with a third of all rows is ranked by many tasks.
    """
    hashed = rows.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}#"), F.col(key).cast("string")))).withColumn("__run", F.substring("__hash", 1, 2))
    runs = hashed.groupBy(stratum, "__run").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(stratum)
    starts = runs.select(
        F.col(stratum).alias("__stratum"), F.col("__run").alias("__of"), (F.sum("__n").over(w.orderBy("__run")) - F.col("__n")).alias("__before"), F.sum("__n").over(w).alias("stratum_rows")
    )
    ranked = hashed.withColumn("__rank", F.row_number().over(Window.partitionBy(stratum, "__run").orderBy("__hash", key)))
    met = ranked.join(starts, F.col(stratum).eqNullSafe(F.col("__stratum")) & (F.col("__run") == F.col("__of")))
    return met.withColumn("place", F.col("__before") + F.col("__rank")).drop("__hash", "__run", "__stratum", "__of", "__before", "__rank")


def stratum_sizes(rows: DataFrame, stratum: str, *sums) -> DataFrame:
    """Rows of each stratum, with sums of other columns."""
    return rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"), *sums)


def stratified_split(rows: DataFrame, stratum: str, key: str, seed: int = 42) -> DataFrame:
    """Adds ``part``, in the order of a hash of seed and key within each stratum."""
    return hashed_places(rows, stratum, key, seed).withColumn("part", split_part(F.col("place"), F.col("stratum_rows")))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by a hash of seed and key, in the order of the key: the sample is the feature."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}#"), F.col(key).cast("string"))), key).limit(n).orderBy(key)


def chat_text(record_content: str = "content", messages: str = "messages", others: tuple[str, ...] = ("ao", "text", "instruction"), columns: tuple[str, ...] = ()) -> Column:
    """First non-blank of the text fields, else the first user message."""
    named = [tx.filled(c) for c in (record_content, *others) if c in columns]
    return F.coalesce(*named, F.get(F.filter(messages, lambda m: (m["role"] == "user") & m["content"].isNotNull()), F.lit(0))["content"], F.lit(""))


def case_id(identifier: Column, source: Column, number: Column) -> Column:
    return F.coalesce(F.nullif(identifier.cast("string"), F.lit("")), F.nullif(source.cast("string"), F.lit("")), F.format_string("case_%04d", number))


def to_chat(cases: DataFrame, system: str) -> DataFrame:
    """(id, source, messages) for supervised tuning: system prompt, text, table as compact JSON."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return cases.select("id", "source", F.array(said("system", F.lit(system)), said("user", F.col("content")), said("assistant", F.to_json("rows"))).alias("messages"))


def chat_errors_strict(messages: Column) -> Column:
    """What is wrong with a chat for evaluation: one question, the truth last."""
    roles = F.transform(messages, lambda m: m["role"])
    n = F.coalesce(F.size(messages), F.lit(0))
    before = F.slice(roles, 1, F.greatest(n - 1, F.lit(0)))
    checks = [
        (n < 2, "too_few_messages"),
        (F.exists(roles, lambda r: ~F.coalesce(r.isin(*ROLES), F.lit(False))), "unknown_role"),
        (F.exists(messages, lambda m: m["content"].isNull()), "content_not_text"),
        (~F.coalesce(F.get(roles, n - 1) == "assistant", F.lit(False)), "last_not_assistant"),
        (F.array_contains(before, "assistant"), "early_assistant"),
        (~F.array_contains(before, "user"), "no_user"),
        (F.array_contains(F.slice(roles, 2, F.greatest(n, F.lit(1))), "system"), "system_not_first"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), name) for bad, name in checks]))


def is_tuning_chat(messages: Column) -> Column:
    """Exactly system, user, assistant, all with text."""
    return F.coalesce((F.transform(messages, lambda m: m["role"]) == F.array(*[F.lit(r) for r in ROLES])) & F.forall(messages, lambda m: m["content"].isNotNull()), F.lit(False))


def normalise_chat(messages: Column, instruction: Column, question: Column, answer: Column) -> Column:
    """Messages as given, or made of instruction, input and output; null where the last answer is blank."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    asked = F.concat_ws("\n", F.nullif(instruction, F.lit("")), F.nullif(question, F.lit("")))
    made = F.coalesce(messages, F.array(said("user", asked), said("assistant", F.coalesce(answer, F.lit("")))))
    last = F.element_at(made, -1)
    return F.when((last["role"] == "assistant") & (tx.strip(last["content"]) != ""), made)


def row_errors(rows: Column) -> Column:
    """Schema errors of a table given as an array of maps from field to (kind, value), kind the JSON type's name."""

    def of_row(row: Column, i: Column) -> Column:
        where = F.concat(F.lit("["), i.cast("string"), F.lit("]"))
        level = F.when(F.element_at(row, F.lit(schema.LEVEL))["kind"] == "string", F.element_at(row, F.lit(schema.LEVEL))["value"])
        typed = F.transform(F.map_entries(F.map_filter(row, lambda _, v: v["kind"] != "string")), lambda e: F.concat(where, F.lit("."), e["key"], F.lit(":not_text")))
        legal = F.coalesce(level.isin(*schema.LEVEL_ORDER), F.lit(False))
        needed = F.lit(None).cast("array<string>")
        for name, fields in schema.LEVEL_FIELDS.items():
            needed = F.when(level == name, F.array(*[F.lit(f) for f in fields])).otherwise(needed)
        missing = F.transform(F.array_except(needed, F.map_keys(row)), lambda f: F.concat(where, F.lit("."), f, F.lit(":missing")))
        closed = [
            F.when((F.element_at(row, F.lit(f))["kind"] == "string") & ~F.element_at(row, F.lit(f))["value"].isin("", *allowed), F.concat(where, F.lit(f".{f}:not_allowed")))
            for f, allowed in schema.CLOSED_DOMAINS.items()
        ]
        wrong = F.when(legal, F.concat(missing, F.array_compact(F.array(*closed)))).otherwise(F.array(F.concat(where, F.lit(f".{schema.LEVEL}:illegal"))))
        return F.when(row.isNull(), F.array(F.concat(where, F.lit(":not_an_object")))).otherwise(F.concat(typed, wrong))

    return F.when(rows.isNull(), F.array(F.lit("not_a_list"))).when(F.size(rows) == 0, F.array(F.lit("empty"))).otherwise(F.flatten(F.transform(rows, of_row)))


def masked_labels(prompt: Column, full: Column) -> Column:
    """Token labels with the prompt's masked as -100; null where the full tokens don't begin with the prompt's."""
    n = F.size(prompt)
    return F.when(F.slice(full, 1, n) == prompt, F.concat(F.array_repeat(F.lit(-100), n), F.slice(full, n + 1, F.greatest(F.size(full) - n, F.lit(0)))))


def padded(tokens: Column, length: Column, pad: int) -> Column:
    return F.concat(tokens, F.array_repeat(F.lit(pad), F.greatest(length - F.size(tokens), F.lit(0))))


def fits_budget(prompt_tokens: Column, new_tokens: int, most: int) -> Column:
    return prompt_tokens + new_tokens <= most


def islands(rows: DataFrame, major: Column, by: list[str], order: str, minor: Column) -> DataFrame:
    """Records opened by major rows: the minor rows after each are its list, in order; leading minors are dropped."""
    group = F.sum(major.cast("int")).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    marked = rows.withColumn("island", group).withColumn("__major", major).where("island > 0")
    return marked.groupBy(*by, "island").agg(F.min_by(order, order).alias("opened_at"), F.transform(F.array_sort(F.collect_list(F.when(~F.col("__major"), F.struct(F.col(order).alias("o"), minor.alias("v"))))), lambda x: x["v"]).alias("minors"))


def merge_judgement(heuristic: Column, judged: Column) -> tuple[Column, Column]:
    """(needed, overridden): the heuristic can only switch on."""
    said = F.coalesce(judged, F.lit(False))
    return said | heuristic, heuristic & ~said


def locate_rows(record: Column) -> Column:
    """The rows of a JSON record: the list itself, else the first list among its row fields."""
    from caselattice.functions.jsonparse import typed_rows

    return F.coalesce(typed_rows(record), *[typed_rows(F.get_json_object(record, f"$.{name}")) for name in schema.RECORD_LIST_KEYS], F.array().cast("array<map<string,struct<kind:string,value:string>>>"))


def measured_lengths(chats: DataFrame, tokens, messages: str = "messages") -> DataFrame:
    """Adds prompt, assistant and total token counts, and whether the whole begins with the prompt's tokens (else the
    assistant's count is null). ``tokens`` maps a text column to an array of tokens."""
    said = lambda upto: F.array_join(F.transform(upto, lambda m: F.concat(m["role"], F.lit("\n"), m["content"], F.lit("\n"))), "")
    held = chats.withColumns({"__prompt": tokens(said(F.slice(messages, 1, F.size(messages) - 1))), "__whole": tokens(said(F.col(messages)))})
    fits = F.slice("__whole", 1, F.size("__prompt")) == F.col("__prompt")
    return held.withColumns(
        {"prompt_tokens": F.size("__prompt"), "total_tokens": F.size("__whole"), "prefix_match": fits, "assistant_tokens": F.when(fits, F.size("__whole") - F.size("__prompt"))}
    ).drop("__prompt", "__whole")
