"""Plan text for assertions."""

import re


def plan(df) -> str:
    execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return execution.explainString(mode.fromString("formatted"))


def exchanges(df) -> int:
    """Shuffles of the plan that is made before it runs; broadcasts don't count."""
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(r"[-+] Exchange \(", tree))
