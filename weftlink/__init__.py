"""weftlink: record linkage and entity resolution as composable PySpark DataFrame operators."""
