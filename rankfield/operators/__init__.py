"""DataFrame operators: loads, retrieval, fusion, selection and profiling."""
