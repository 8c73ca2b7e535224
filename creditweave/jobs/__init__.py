"""spark-submit entry points. The library never stops a session; only these do."""
