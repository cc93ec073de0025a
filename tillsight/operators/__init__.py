"""The analytics (A1-A15), preparation steps (C1-C8) and funnel, as DataFrame functions."""
