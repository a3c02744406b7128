"""DataFrame -> DataFrame steps, meant for DataFrame.transform."""
