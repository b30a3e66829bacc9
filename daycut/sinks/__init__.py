"""Outputs: the JSONL lake and the day-partitioned warehouse tables."""
