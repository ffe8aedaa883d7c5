"""The star container, the warehouse build, and the query catalogue."""
