"""Movement-ledger reconciliation and KPI reporting as composable Spark DataFrame operators."""
