"""Column functions: Column -> Column, no UDFs."""
