"""Landed JSON pages to tables."""
