"""SQL functions by the name that users of the ad-hoc surface know, in Spark's form.

``call(name, *arguments)`` gives a column; arguments are SQL texts. A form is
Spark SQL with the arguments' places in braces. Names whose meaning needs more
than one expression are in ``dialect``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that Spark has with the same meaning.
SAME = (
    "count sum avg min max median mode stddev stddev_pop stddev_samp var_pop var_samp variance approx_count_distinct any_value first last corr covar_pop covar_samp bool_and bool_or "
    "coalesce ifnull nullif nvl greatest least if abs ceil ceiling floor round sign sqrt cbrt exp ln log2 log10 pow power mod acos asin atan atan2 cos sin tan cot degrees radians pi factorial "
    "length lower upper trim ltrim rtrim lpad rpad concat_ws replace reverse repeat split_part contains instr left right md5 translate ascii chr levenshtein printf "
    "date_trunc day dayofmonth dayofyear hour minute month quarter weekofyear year make_date make_timestamp current_date typeof json_array_length array_contains range"
).split()

#: Names with another form in Spark.
OTHER = {
    "arg_min": "min_by({0}, {1})",
    "arg_max": "max_by({0}, {1})",
    "quantile_cont": "percentile_cont({1}) WITHIN GROUP (ORDER BY {0})",
    "quantile_disc": "percentile_disc({1}) WITHIN GROUP (ORDER BY {0})",
    "group_concat": "listagg({0}, {1}) WITHIN GROUP (ORDER BY {0})",
    "product": "aggregate(collect_list(double({0})), double(1), (a, x) -> a * x, a -> nullif(a, if(size(collect_list({0})) = 0, a, NULL)))",
    "log": "log10({0})",
    "trunc": "sign({0}) * floor(abs({0}))",
    "even": "sign({0}) * 2 * ceil(abs({0}) / 2)",
    "random": "rand()",
    "setseed": "rand({0})",
    "starts_with": "startswith({0}, {1})",
    "ends_with": "endswith({0}, {1})",
    "position": "instr({1}, {0})",
    "strpos": "instr({0}, {1})",
    "substring": "if({1} = 0, substring({0}, 1, {2} - 1), substring({0}, {1}, {2}))",
    "hash": "xxhash64({0})",
    "sha256": "sha2({0}, 256)",
    "regexp_matches": "{0} rlike {1}",
    "regexp_extract": "regexp_extract({0}, {1}, {2})",
    "regexp_extract_all": "regexp_extract_all({0}, {1}, 0)",
    "regexp_split_to_array": "split({0}, {1})",
    "str_split": "split({0}, concat('\\\\Q', {1}, '\\\\E'))",
    "date_part": "cast(extract({0} FROM {1}) AS bigint)",
    "datepart": "cast(extract({0} FROM {1}) AS bigint)",
    "extract": "cast(extract({0} FROM {1}) AS bigint)",
    "date_add": "cast({0} AS timestamp) + {1}",
    "microsecond": "cast(extract(SECOND FROM {0}) * 1000000 AS bigint)",
    "millisecond": "cast(extract(SECOND FROM {0}) * 1000 AS bigint)",
    "second": "cast(floor(extract(SECOND FROM {0})) AS bigint)",
    "weekday": "dayofweek({0}) - 1",
    "to_timestamp": "timestamp_seconds({0})",
    "make_time": "make_dt_interval(0, {0}, {1}, {2})",
    "today": "current_date()",
    "try_cast": "try_cast({0} AS {1})",
    "cast": "cast({0} AS {1})",
    "to_json": "to_json({0})",
    "json_extract": "get_json_object({0}, {1})",
    "json_extract_string": "get_json_object({0}, {1})",
    "json_value": "if(left(get_json_object({0}, {1}), 1) IN ('{{', '['), NULL, get_json_object({0}, {1}))",
    "json_keys": "json_object_keys({0})",
    "json_type": "CASE regexp_extract(schema_of_variant(parse_json({0})), '^[A-Z]+', 0) WHEN 'OBJECT' THEN 'OBJECT' WHEN 'ARRAY' THEN 'ARRAY' WHEN 'STRING' THEN 'VARCHAR' WHEN 'BIGINT' THEN 'BIGINT' WHEN 'BOOLEAN' THEN 'BOOLEAN' WHEN 'VOID' THEN 'NULL' ELSE 'DOUBLE' END",
    "age": "make_ym_interval(0, cast(timestampdiff(MONTH, {1}, {0}) AS int))",
    "list_value": "array({args})",
    "array_length": "size({0})",
    "len": "length({0})",
    "list_contains": "array_contains({0}, {1})",
    "struct_pack": "named_struct({args})",
    "generate_series": "sequence({0}, {1})",
}


def sql(name: str, *arguments: str) -> str:
    if name in OTHER:
        return OTHER[name].format(*arguments, args=", ".join(arguments))
    if name in SAME:
        return f"{name}({', '.join(arguments)})"
    raise ValueError(f"no such function: {name}")


def call(name: str, *arguments: str) -> Column:
    return F.expr(sql(name, *arguments))
