"""Column expressions and exact statistics shared by the operators."""
