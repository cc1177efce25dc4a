"""Column expressions: parsing of dirty text, exact measures and business labels."""
