"""Funnelwright: conversion analytics over delivered contacts and partner CRM snapshots, on Spark.

Every operator is a function of DataFrames or Columns that returns a lazy DataFrame or Column. Jobs that
write tables live in :mod:`funnelwright.plans`.
"""
