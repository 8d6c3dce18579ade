"""Staging, marts, measures, KPIs and checks."""
