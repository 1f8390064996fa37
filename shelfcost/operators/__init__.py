"""DataFrame -> DataFrame operators of the rollup, report and v1 rule set."""
