"""Sources: fixture views over the given tables, file readers, input discovery."""
