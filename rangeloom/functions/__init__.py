"""Column functions: batch ids, ranges, hex, event decoding, keys."""
