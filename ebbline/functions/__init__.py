"""Column expressions: tokens, event decoding, decay arithmetic, item shapes."""
