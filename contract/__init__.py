"""The driver's tables mapped onto the raw layer, the queries over them and their SQL oracle."""
