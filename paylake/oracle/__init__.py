"""The same results written a second time, as SQL for an independent engine."""
