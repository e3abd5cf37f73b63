"""Column expressions (text, vectors, prompts, cost) and the Arrow-batched
MaxSim kernels."""
