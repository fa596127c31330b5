"""Request plans, reports and jobs."""
