"""The row-local filters and the greedy duplicate filter under Structured Streaming."""
