"""Prepare supervised fine-tuning sets with Spark: detect columns, render text,
encode, order, batch and write. All functions take and return DataFrames or
columns; the session and its settings belong to the caller."""

from rowscribe.plans.job import JobParameters, JobReport, prepare, run

__all__ = ["JobParameters", "JobReport", "prepare", "run"]
