"""Bronze, Silver and Gold jobs composed from the operators."""
