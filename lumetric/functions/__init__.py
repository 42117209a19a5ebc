"""Column expressions: text and key parsing, conversions, rates, image features."""
