"""Spark jobs that join coded health records with exposure data."""
