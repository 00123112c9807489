"""DataFrame-to-DataFrame operators; batch and streaming alike unless a docstring says otherwise."""
