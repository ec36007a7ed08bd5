"""Matrix operators, each a lazy DataFrame plan unless its text says it runs a job."""
