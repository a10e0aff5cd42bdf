"""SQL of the text queries that SQL can express."""

ORACLE: dict[str, str] = {}
