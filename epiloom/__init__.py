"""Cohort construction, incidence and characterization as Spark jobs."""
