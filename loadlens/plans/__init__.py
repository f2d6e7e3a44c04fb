"""Registered queries: a Spark plan and its equivalent DuckDB SQL per key."""
