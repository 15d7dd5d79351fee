"""Fixed input schemas."""

from pyspark.sql import types as T

CANDIDATE = T.StructType(
    [
        T.StructField("election_year", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("constituency", T.StringType()),
        T.StructField("constituency_id", T.IntegerType()),
        T.StructField("candidate_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("party", T.StringType()),
        T.StructField("criminal_cases", T.IntegerType()),
        T.StructField("education", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("assets", T.LongType()),
        T.StructField("liabilities", T.LongType()),
        T.StructField("is_winner", T.BooleanType()),
        T.StructField("is_bye_election", T.BooleanType()),
        T.StructField("source_url", T.StringType()),
    ]
)

FUND = T.StructType(
    [
        T.StructField("tenure", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("state_id", T.IntegerType()),
        T.StructField("constituency", T.StringType()),
        T.StructField("constituency_id", T.IntegerType()),
        T.StructField("mp_name", T.StringType()),
        T.StructField("mp_id", T.IntegerType()),
        T.StructField("allocated", T.LongType()),
        T.StructField("expenditure", T.LongType()),
        T.StructField("works_recommended", T.IntegerType()),
        T.StructField("works_recommended_amt", T.LongType()),
        T.StructField("works_sanctioned", T.IntegerType()),
        T.StructField("works_sanctioned_amt", T.LongType()),
        T.StructField("works_completed", T.IntegerType()),
        T.StructField("works_completed_amt", T.LongType()),
        T.StructField("pct_spent", T.DoubleType()),
    ]
)

CROSS_CHECK = T.StructType(
    [
        T.StructField("house", T.StringType()),
        T.StructField("allocatedAmount", T.DoubleType()),
        T.StructField("totalExpenditure", T.DoubleType()),
        T.StructField("completedWorksCount", T.IntegerType()),
        T.StructField("recommendedWorksCount", T.IntegerType()),
    ]
)
