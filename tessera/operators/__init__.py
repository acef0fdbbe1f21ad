"""Operators: functions ``DataFrame (+ parameters) -> DataFrame``."""
