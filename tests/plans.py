"""What a test reads from an executed plan."""

import re


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def folder_filters(df):
    """The folder filters of each scan of a bucketed table; long ones are cut by Spark's text of the plan."""
    return re.findall(r"FileScan parquet \[[^\]]*bucket#.*?PartitionFilters: (.*?), PushedFilters", executed(df))
