"""The star schema build, the metric layer, reports and check suites."""
