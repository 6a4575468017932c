"""Writers: compute first, switch readers over last."""
