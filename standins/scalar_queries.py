"""The column functions, each on whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import columns as c
from standins.catalogue import register
from standins.relations import Standins, academy, dataset

_ROWS = f"""
    select o_orderkey, {academy('o_custkey')} Academy, {dataset('o_custkey')} DataSet, o_orderkey%14 year_no,
      case when o_orderstatus='P' then null else o_custkey end maybe_id, o_orderstatus, o_orderpriority,
      cast(o_orderdate as date) order_day,
      case o_orderstatus when 'O' then concat(cast(cast(o_orderdate as date) as string),'T08:30:00Z')
        when 'F' then cast(cast(o_orderdate as date) as string) end date_text,
      case when o_orderstatus='P' then 'N/A' else cast(2019+o_custkey%3 as string) end year_text,
      concat(case when o_orderstatus='F' then 'True' else 'False' end,' or True') answer
    from {{orders}}
    """


def _scalars(t: Standins) -> DataFrame:
    return t.sql(_ROWS).select(
        "o_orderkey",
        c.surrogate_key("o_orderkey").alias("plain_key"),
        c.surrogate_key("o_orderkey", "maybe_id").alias("two_part_key"),
        c.surrogate_key("maybe_id").alias("gap_key"),
        c.optional_key("maybe_id").alias("optional_key"),
        c.text_date("date_text").alias("text_day"),
        c.text_moment("date_text").alias("text_moment"),
        c.year_group_label("year_no").alias("year_label"),
        c.request_date_label("order_day").alias("day_label"),
        c.number_or_zero("maybe_id").alias("number_or_zero"),
        c.flag_or_false(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")).alias("flag_or_false"),
        c.yes_no("answer").alias("yes_no"),
        c.converted_text(F.concat_ws(" ", *["o_orderpriority"] * 4)).alias("converted"),
        F.coalesce(c.same_year("year_text", 2021), F.lit(False)).alias("same_year"),
        c.grade_text("o_orderpriority", "date_text").alias("grade_plain"),
        c.grade_text("o_orderpriority", "date_text", prefer_alias=True).alias("grade_alias"),
    )


register(
    "scalar_functions",
    _scalars,
    f"""
    select o_orderkey, concat(Academy,DataSet,'-',cast(o_orderkey as string)) plain_key,
      concat(Academy,DataSet,'-',cast(o_orderkey as string),'-',coalesce(cast(maybe_id as string),'')) two_part_key,
      concat(Academy,DataSet,'-',coalesce(cast(maybe_id as string),'')) gap_key,
      case when maybe_id is not null then concat(Academy,DataSet,'-',cast(maybe_id as string)) end optional_key,
      case when o_orderstatus='O' then order_day end text_day,
      case o_orderstatus when 'O' then cast(order_day as timestamp) + interval 510 minutes
        when 'F' then cast(order_day as timestamp) end text_moment,
      case when year_no=0 then 'Reception' else cast(year_no as string) end year_label,
      strftime(order_day,'%Y-%m-%d') day_label, coalesce(maybe_id,0) number_or_zero,
      coalesce(o_orderstatus='F',false) flag_or_false, replace(replace(answer,'True','Yes'),'False','No') yes_no,
      substring(concat_ws(' ',o_orderpriority,o_orderpriority,o_orderpriority,o_orderpriority),1,30) converted,
      coalesce(try_cast(year_text as int)=2021,false) same_year, o_orderpriority grade_plain,
      coalesce(date_text,o_orderpriority) grade_alias
    from ({_ROWS})
    """,
)
