"""Queries over the functions of ``functions.forms``, a family each, with edge values."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import add
from .functions import dialect
from .functions.forms import call, sql
from .plans import consolidate as plan


def family(name: str, table: str, keys: list[str], rows: list[tuple]) -> None:
    """``rows``: column, function, Spark arguments, the other engine's expression;
    and, if values are to be made comparable, a wrapper for both with {} in it."""
    by_key = ", ".join(keys)

    def query(s, p):
        columns = []
        for column, function, arguments, _, *wrap in rows:
            columns.append(F.expr((wrap[0] if wrap else "{}").format(sql(function, *arguments))).alias(column))
        return plan.table(s, p, table).select(*keys, *columns)

    other = ", ".join(f"{(r[4] if len(r) == 5 else r[5] if len(r) == 6 else '{}').format(r[3])} AS {r[0]}" for r in rows)
    add(name, query, f"SELECT {by_key}, {other} FROM {table}")


R9 = "round({}, 9)"
_X = "(l_quantity / 51 * if(l_linenumber % 2 = 0, 1, -1))"
_XD = "(l_quantity / 51 * if(l_linenumber % 2 = 0, 1, -1))"
family("s_numeric_more", "lineitem", ["l_orderkey", "l_linenumber"], [
    ("abs", "abs", ["-l_tax"], "abs(-l_tax)"),
    ("ceil", "ceil", ["-l_quantity / 7"], "CAST(ceil(-l_quantity / 7) AS BIGINT)"),
    ("ceiling", "ceiling", ["l_quantity / 7"], "CAST(ceiling(l_quantity / 7) AS BIGINT)"),
    ("floor", "floor", ["-l_quantity / 7"], "CAST(floor(-l_quantity / 7) AS BIGINT)"),
    ("exp", "exp", [_X], f"exp({_XD})", R9),
    ("ln", "ln", ["l_quantity"], "ln(l_quantity)", R9),
    ("log2", "log2", ["l_quantity"], "log2(l_quantity)", R9),
    ("log10", "log10", ["l_extendedprice"], "log10(l_extendedprice)", R9),
    ("power", "power", ["l_tax + 1", "-3"], "power(l_tax + 1, -3)", R9),
    ("acos", "acos", [_X], f"acos({_XD})", R9),
    ("atan", "atan", [_X], f"atan({_XD})", R9),
    ("tan", "tan", [_X], f"tan({_XD})", R9),
    ("cot", "cot", ["l_tax + 1"], "cot(l_tax + 1)", R9),
    ("pi", "pi", [], "pi()", R9),
    ("sqrt", "sqrt", ["l_tax"], "sqrt(l_tax)", R9),
    ("sign", "sign", [_X], f"CAST(sign({_XD}) AS DOUBLE)"),
    ("factorial", "factorial", ["cast(l_linenumber as int)"], "CAST(factorial(CAST(l_linenumber AS INTEGER)) AS BIGINT)"),
    ("random", "random", [], "random()", "{} BETWEEN 0 AND 1"),
    ("setseed", "setseed", ["7"], "TRUE", "{} = rand(7)", "{}"),
])
family("s_conditional", "lineitem", ["l_orderkey", "l_linenumber"], [
    ("nullif", "nullif", ["l_returnflag", "'N'"], "nullif(l_returnflag, 'N')"),
    ("ifnull", "ifnull", ["nullif(l_returnflag, 'N')", "'none'"], "ifnull(nullif(l_returnflag, 'N'), 'none')"),
    ("nvl", "nvl", ["nullif(l_linenumber, 1)", "-1"], "coalesce(nullif(l_linenumber, 1), -1)"),
    ("greatest", "greatest", ["l_partkey", "nullif(l_suppkey, 1)", "NULL"], "greatest(l_partkey, nullif(l_suppkey, 1), NULL)"),
    ("least", "least", ["l_partkey", "nullif(l_suppkey, 1)"], "least(l_partkey, nullif(l_suppkey, 1))"),
    ("either", "if", ["l_tax > 0.04", "'high'", "'low'"], "if(l_tax > 0.04, 'high', 'low')"),
    ("either_null", "if", ["nullif(l_linenumber, 1) > 3", "'high'", "'low'"], "if(nullif(l_linenumber, 1) > 3, 'high', 'low')"),
    ("try_bad", "try_cast", ["l_returnflag", "int"], "TRY_CAST(l_returnflag AS INTEGER)"),
    ("try_good", "try_cast", ["concat('', l_linenumber)", "int"], "TRY_CAST(concat('', l_linenumber) AS INTEGER)"),
    ("kind", "typeof", ["l_returnflag"], "typeof(l_returnflag)", "if({} = 'string', 'text', 'other')", "if({} = 'VARCHAR', 'text', 'other')"),
])
_S = "c_name"
family("s_text_more", "customer", ["c_custkey"], [
    ("ltrim", "ltrim", ["concat('  ', c_mktsegment, ' ')"], "ltrim(concat('  ', c_mktsegment, ' '))"),
    ("rtrim", "rtrim", ["concat('  ', c_mktsegment, ' ')"], "rtrim(concat('  ', c_mktsegment, ' '))"),
    ("rpad", "rpad", ["c_mktsegment", "12", "'.-'"], "rpad(c_mktsegment, 12, '.-')"),
    ("rpad_cut", "rpad", ["c_name", "4", "'.'"], "rpad(c_name, 4, '.')"),
    ("substring0", "substring", ["c_name", "0", "4"], "substring(c_name, 0, 4)"),
    ("substring_back", "substring", ["c_name", "-3", "2"], "substring(c_name, -3, 2)"),
    ("replaced", "replace", ["c_name", "'0'", "'oo'"], "replace(c_name, '0', 'oo')"),
    ("reversed", "reverse", ["c_name"], "reverse(c_name)"),
    ("repeated", "repeat", ["c_mktsegment", "cast(c_custkey % 3 as int)"], "repeat(c_mktsegment, c_custkey % 3)"),
    ("starts", "starts_with", ["c_mktsegment", "'B'"], "starts_with(c_mktsegment, 'B')"),
    ("ends", "ends_with", ["c_name", "'7'"], "ends_with(c_name, '7')"),
    ("has", "contains", ["c_name", "'00'"], "contains(c_name, '00')"),
    ("at", "instr", ["c_name", "'#'"], "instr(c_name, '#')"),
    ("position", "position", ["'zz'", "c_name"], "position('zz' IN c_name)"),
    ("end", "right", ["c_name", "3"], "right(c_name, 3)"),
    ("md5", "md5", ["c_name"], "md5(c_name)"),
    ("hashed", "hash", ["c_name"], "TRUE", "{} = xxhash64(c_name)", "{}"),
    ("extracted", "regexp_extract", ["c_name", r"'([A-Za-z]+)#0*([1-9])'", "2"], r"regexp_extract(c_name, '([A-Za-z]+)#0*([1-9])', 2)"),
    ("extract_none", "regexp_extract", ["c_name", "'x+'", "0"], "regexp_extract(c_name, 'x+', 0)"),
    ("all_found", "regexp_extract_all", ["c_name", "'[1-9]'"], "regexp_extract_all(c_name, '[1-9]')", "array_join({}, ',')", "array_to_string({}, ',')"),
    ("parts", "regexp_split_to_array", ["c_name", "'[#0]+'"], "regexp_split_to_array(c_name, '[#0]+')", "array_join({}, ',')", "array_to_string({}, ',')"),
    ("split", "str_split", ["c_name", "'0'"], "str_split(c_name, '0')", "array_join({}, ',')", "array_to_string({}, ',')"),
    ("translated", "translate", ["c_mktsegment", "'AEIOU'", "'4'"], "translate(c_mktsegment, 'AEIOU', '4')"),
    ("ascii", "ascii", ["c_mktsegment"], "ascii(c_mktsegment)"),
    ("chr", "chr", ["65 + c_custkey % 26"], "chr(CAST(65 + c_custkey % 26 AS INTEGER))"),
])
_D, _T = "o_orderdate", "ts"
_BIG = "cast({} as bigint)"
family("s_dates_more", "orders", ["o_orderkey"], [
    *[(f"part_{u}", f, [u, _D], f"{f if f != 'extract' else 'date_part'}('{u}', o_orderdate)", _BIG) for f, u in (("date_part", "year"), ("datepart", "month"), ("extract", "quarter"))],
    ("trunc_month", "date_trunc", ["'month'", _D], "date_trunc('month', o_orderdate)", "cast(to_date({}) as string)", "CAST(CAST({} AS DATE) AS VARCHAR)"),
    ("trunc_week", "date_trunc", ["'week'", _D], "date_trunc('week', o_orderdate)", "cast(to_date({}) as string)", "CAST(CAST({} AS DATE) AS VARCHAR)"),
    ("added", "date_add", [_D, "INTERVAL '1' MONTH"], "date_add(o_orderdate, INTERVAL 1 MONTH)", "cast(to_date({}) as string)", "CAST(CAST({} AS DATE) AS VARCHAR)"),
    ("age_months", "age", ["timestamp'2001-09-30'", _D], "date_part('year', age(TIMESTAMP '2001-09-30', o_orderdate)) * 12 + date_part('month', age(TIMESTAMP '2001-09-30', o_orderdate))", "cast(extract(YEAR FROM {0}) * 12 + extract(MONTH FROM {0}) as bigint)", "CAST({} AS BIGINT)"),
    *[(f"u_{u}", u, [_D], f"{u}(o_orderdate)", _BIG) for u in ("day", "dayofmonth", "dayofyear", "month", "quarter", "weekofyear", "year", "weekday")],
    ("made", "make_date", ["year(o_orderdate)", "month(o_orderdate)", "1"], "make_date(year(o_orderdate), month(o_orderdate), 1)", "cast({} as string)", "CAST({} AS VARCHAR)"),
    ("made_ts", "make_timestamp", ["year(o_orderdate)", "2", "3", "4", "5", "6.25"], "make_timestamp(year(o_orderdate), 2, 3, 4, 5, 6.25)", "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSS')", "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"),
    ("from_epoch", "to_timestamp", ["o_orderkey * 86461"], "to_timestamp(o_orderkey * 86461)", "unix_seconds({})", "CAST(epoch({}) AS BIGINT)"),
    ("now", "current_date", [], "current_date", "{} >= date'2024-01-01'", "{} >= DATE '2024-01-01'"),
    ("today", "today", [], "today()", "{} = current_date()", "{} = current_date"),
])
family("s_times", "events", ["event_id"], [
    ("hour", "hour", [_T], "hour(ts)", _BIG),
    ("minute", "minute", [_T], "minute(ts)", _BIG),
    ("second", "second", [_T], "second(ts)", _BIG),
    ("millisecond", "millisecond", [_T], "millisecond(ts)", _BIG),
    ("microsecond", "microsecond", [_T], "microsecond(ts)", _BIG),
    ("trunc_hour", "date_trunc", ["'hour'", _T], "date_trunc('hour', ts)", "date_format({}, 'yyyy-MM-dd HH')", "strftime({}, '%Y-%m-%d %H')"),
    ("made", "make_time", ["hour(ts)", "minute(ts)", "0"], "make_time(hour(ts), minute(ts), 0)", "cast(extract(HOUR FROM {0}) * 60 + extract(MINUTE FROM {0}) as bigint)", "CAST(hour({0}) * 60 + minute({0}) AS BIGINT)"),
])
family("s_json_more", "events", ["event_id"], [
    ("extracted", "json_extract", ["props", "'$.k'"], "json_extract_string(props, '$.k')"),
    ("missing", "json_value", ["props", "'$.nothing'"], "json_extract_string(props, '$.nothing')"),
    ("value", "json_value", ["props", "'$.k'"], "json_extract_string(props, '$.k')"),
    ("no_scalar", "json_value", ["concat('{\"a\": ', props, '}')", "'$.a'"], "CAST(NULL AS VARCHAR)"),
    ("n", "json_array_length", ["concat('[1, ', props, ', [2, 3]]')"], "json_array_length(concat('[1, ', props, ', [2, 3]]'))", _BIG),
    ("type_object", "json_type", ["props"], "json_type(props)"),
    ("type_array", "json_type", ["concat('[', props, ']')"], "json_type(concat('[', props, ']'))"),
    ("made", "to_json", ["named_struct('id', event_id, 'kind', event_type)"], "to_json(struct_pack(id := event_id, kind := event_type))", "{}", "CAST({} AS VARCHAR)"),
    ("list", "list_value", ["user_id", "NULL", "event_id"], "list_value(user_id, NULL, event_id)", "concat_ws(',', transform({}, x -> cast(x as string)))", "array_to_string({}, ',')"),
    ("list_n", "array_length", ["array(user_id, NULL, event_id)"], "array_length([user_id, NULL, event_id])", _BIG),
    ("packed", "struct_pack", ["'u', user_id", "'e', event_type"], "struct_pack(u := user_id, e := event_type)", "({}).e", "({}).e"),
])
add(
    "s_aggregates_more",
    lambda s, p: plan.table(s, p, "lineitem").groupBy("l_returnflag").agg(
        call("mode", "l_linenumber").alias("mode"), F.expr("round(stddev_pop(l_quantity), 6)").alias("sdp"), F.expr("round(stddev_samp(l_quantity), 6)").alias("sds"), F.expr("round(var_samp(l_quantity), 6)").alias("vs"), F.expr("round(variance(l_tax), 9)").alias("va"),
        F.expr("approx_count_distinct(l_partkey) between 0.8 * count(distinct l_partkey) and 1.2 * count(distinct l_partkey)").alias("near"), F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("argmax"), F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("lines"),
        call("any_value", "l_returnflag").alias("any"), F.expr("round(covar_pop(l_quantity, l_tax), 6)").alias("cp"), F.expr("round(covar_samp(l_quantity, l_tax), 6)").alias("cs"), F.round(F.product(1 + F.col("l_tax") / 100), 6).alias("product"),
    ),
    "SELECT l_returnflag, mode(l_linenumber) AS mode, round(stddev_pop(l_quantity), 6) AS sdp, round(stddev_samp(l_quantity), 6) AS sds, round(var_samp(l_quantity), 6) AS vs, round(variance(l_tax), 9) AS va, TRUE AS near, arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS argmax, group_concat(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS lines, any_value(l_returnflag) AS any, round(covar_pop(l_quantity, l_tax), 6) AS cp, round(covar_samp(l_quantity, l_tax), 6) AS cs, round(product(1 + l_tax / 100), 6) AS product FROM lineitem GROUP BY 1",
)
add("s_histogram", lambda s, p: dialect.histogram(plan.table(s, p, "orders"), "o_orderpriority").select(F.explode("histogram").alias("x", "n")), "SELECT unnest(map_keys(h)) AS x, CAST(unnest(map_values(h)) AS BIGINT) AS n FROM (SELECT histogram(o_orderpriority) AS h FROM orders)")
add("s_range", lambda s, p: plan.table(s, p, "nation").select("n_nationkey", F.explode(F.expr("sequence(0, n_nationkey)")).alias("k")).where("k < n_nationkey"), "SELECT n_nationkey, CAST(unnest(range(n_nationkey)) AS INTEGER) AS k FROM nation")
