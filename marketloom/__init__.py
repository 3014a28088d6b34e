"""Retail analytics on Spark: raw files -> typed tables -> business answers.

Public functions take and return DataFrames (or Columns).  Jobs are run by
:mod:`marketloom.plans.refresh`, the stores and ``sources.scratch.stored``.
"""
