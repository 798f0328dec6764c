"""Document-quality analytics expressed as DataFrame plans."""
