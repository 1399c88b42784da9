"""Reports, analytics and the jobs that move data from zone to zone."""
