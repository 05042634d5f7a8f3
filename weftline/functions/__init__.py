"""weftline.functions"""
