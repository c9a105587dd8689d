"""Classic data-intensive workloads as plain DataFrame-in, DataFrame-out functions on Spark."""
