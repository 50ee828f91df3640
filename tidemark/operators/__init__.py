"""DataFrame -> DataFrame operators (no UDFs, no collect)."""
