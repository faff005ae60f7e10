"""Runs over the tables (daily, backfill, job) and the registered queries with their SQL oracle."""
